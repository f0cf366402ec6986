"""DuckDB SQL for the queries that SQL can express."""

_SPACE = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op2_decontamination"] = rf"""
with docs as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), bench as (
  select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win
  from bench, unnest(range(1, len(w) - least(10, len(w)) + 2)) as r(i) where len(w) > 0
), runs as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as win
  from docs, (select distinct n from windows) as lengths, unnest(range(1, len(w) - n + 2)) as r(i)
), found as (
  select distinct doc_id, item_id, i, runs.n from runs join windows on runs.win = windows.win and runs.n = windows.n
), hit as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join items using (doc_id)
"""

_CHUNK = "lpad(upper(to_base(cast('0x' || substr(h, {0}, 10) as bigint), 32)), 8, '0')"
_DIGEST = "translate(" + " || ".join(_CHUNK.format(i) for i in (1, 11, 21, 31)) + ", '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"

ORACLE["op3_warc_normaliser"] = f"""
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
 g as (select *, max(page_id) over (partition by h) as first_id from p)
select page_id, cast(octet_length(encode(body)) as bigint) as payload_bytes, {_DIGEST} as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id = first_id then null else first_id end as refers_to
from g
"""

# Lines within one edit share the line without one character, or one of them is
# the other without one character.
ORACLE["op10_line_dedup"] = r"""
with raw as (
  select doc_id, string_split(text, chr(10)) as ls from documents
), lines as (
  select doc_id, i - 1 as pos, trim(ls[i], chr(32) || chr(9) || chr(13)) as line from raw, unnest(range(1, len(ls) + 1)) as r(i)
), long as (
  select *, row_number() over (order by doc_id, pos) as k from lines where length(line) >= 10
), firsts as (
  select line, min(k) as k from long group by line
), variants as (
  select k, line, line as variant from firsts where length(line) >= 32
  union all
  select k, line, substr(line, 1, i - 1) || substr(line, i + 1) from firsts, unnest(range(1, length(line) + 1)) as r(i)
  where length(line) >= 32
), hashed as (
  select distinct k, md5_number(variant) as v from variants
), pairs as (
  select distinct a.k as k, b.k as earlier from hashed a join hashed b on a.v = b.v and b.k < a.k
), near as (
  select distinct p.k from pairs p join firsts a on a.k = p.k join firsts b on b.k = p.earlier where levenshtein(a.line, b.line) <= 1
), marked as (
  select l.doc_id, l.pos, l.k <> f.k as equal, n.k is not null as near
  from long l join firsts f using (line) left join near n on n.k = f.k
), gone as (
  select doc_id, count(*) filter (where equal) as n_equal, count(*) filter (where near and not equal) as n_near,
    string_agg(cast(pos as varchar), ',' order by pos) as removed from marked where equal or near group by doc_id
)
select doc_id, cast(coalesce(len(ls), 0) as bigint) as n_lines, coalesce(n_equal, 0) as n_equal, coalesce(n_near, 0) as n_near,
  coalesce(removed, '') as removed
from raw left join gone using (doc_id)
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE["op13_source_divergence"] = f"""
with d as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, {_TERMS} as ts from documents
), occ as (
  select rid, lang, source, unnest(ts) as term from d
), df as (
  select lang, term from occ group by lang, term having count(distinct rid) >= 30
), v as (
  select l.lang, count(df.term) as v from (select distinct lang from d) l left join df using (lang) group by l.lang
), gc as (
  select lang, source, term, count(*) as c from occ join df using (lang, term) group by all
), groups as (
  select g.lang, g.source, coalesce(sum(gc.c), 0) as n from (select distinct lang, source from d) g left join gc using (lang, source) group by all
), langs as (
  select lang, sum(n) as n from groups group by lang
), p as (
  select g.lang, g.source, df.term, coalesce(gc.c, 0) as c,
    1 + (1000000000::hugeint * (coalesce(gc.c, 0) + 5)) // (g.n + 5 * v.v) as p
  from groups g join df using (lang) join v using (lang) left join gc on gc.lang = g.lang and gc.source = g.source and gc.term = df.term
), q as (
  select df.lang, df.term, 1 + (1000000000::hugeint * (coalesce(sum(gc.c), 0) + 5)) // (langs.n + 5 * v.v) as q
  from df join langs using (lang) join v using (lang) left join gc using (lang, term) group by df.lang, df.term, langs.n, v.v
), diffs as (
  select pa.lang, pa.source, pb.source as item, sum(abs(pa.p - pb.p)) as value
  from p pa join p pb on pa.lang = pb.lang and pa.term = pb.term and pa.source <> pb.source group by all
), pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(diffs.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join diffs on diffs.lang = a.lang and diffs.source = a.source and diffs.item = b.source
), term as (
  select p.lang, p.source, 'term' as part, p.term as item, p.p - q.q as value from p join q using (lang, term) where p.c > 0 and p.p > q.q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item) asc) as rank from (select * from pair union all select * from term)
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 50
"""

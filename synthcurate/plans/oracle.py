"""The registered queries as SQL for a second engine.

``CTES`` defines the intermediate relations, in order of dependency; a query
text gets the ones it uses, so every text stands alone.
"""

from __future__ import annotations

import re

from synthcurate.functions.text import WHITESPACE
from synthcurate.operators.prompts import SLOTS, format_instructions
from synthcurate.plans.inputs import MODELS, TEMPLATES
from synthcurate.sources.readers import packaged_templates

BLANKS = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(names: tuple[str, ...], key: str) -> str:
    cases = " ".join(f"when {n} then {text(name)}" for n, name in enumerate(names))
    return f"case {key} % {len(names)} {cases} end"


def letters(n: str) -> str:
    return f"translate(cast({n} as varchar), '0123456789', 'ABCDEFGHIJ')"


def strip(value: str) -> str:
    return f"trim({value}, {BLANKS})"


def hash60(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15))::bigint"


def template_values() -> str:
    rows = []
    for name, body in sorted(packaged_templates().items()):
        mode = "zero-shot" if "zero-shot" in name else "few-shot"
        pool = "'train'" if "train-time-info" in name else "'validation'" if "test-time-info" in name else "null"
        rows.append(f"({text(name)}, {text(body)}, {text(mode)}, {pool}, {str('_bg_' in name).lower()})")
    return ", ".join(rows)


def rendered() -> str:
    """One branch per template: its text pieces with the slot values between."""
    values = {"format_instructions": text(format_instructions()), "examples": "examples", "stock_ticker": "stock_ticker"}
    branches = []
    for name, body in sorted(packaged_templates().items()):
        pieces = re.split("({(?:" + "|".join(SLOTS) + ")})", body)
        parts = [values[p[1:-1]] if p[1:-1] in SLOTS else text(p) for p in pieces]
        branches.append(f"when {text(name)} then concat({', '.join(parts)})")
    return f"case template {' '.join(branches)} end"


def model_name(m: str) -> str:
    flat = f"lower(replace({m}, '-', ''))"

    def has(part: str) -> str:
        return f"contains({flat}, '{part}')"

    return (
        f"concat(case when {has('llama')} then concat('llama', case when {has('70b')} then '3.3-70b'"
        f" when {has('8b')} then '3.1-8b' else '' end)"
        f" when {has('qwen2.5')} then concat('qwen2.5', case when {has('coder')} then '-coder' else '' end,"
        f" case when {has('7b')} then '-7b' when {has('32b')} then '-32b' else '' end)"
        f" else replace({m}, '/', '--') end, case when {has('instruct')} then '-instruct' else '' end)"
    )


KEYS_OK = "(coalesce(json_type(x) = 'OBJECT' and list_sort(json_keys(x)) = ['headline','sentiment'], false))"
HEADLINE_OK = "(coalesce(json_type(x, '$.headline') = 'VARCHAR' and regexp_matches(x->>'$.headline', '[a-zA-Z]'), false))"
SENTIMENT_OK = (
    "(coalesce(json_type(x, '$.sentiment') in ('VARCHAR','UBIGINT','BIGINT')"
    " and (x->>'$.sentiment') in ('0','1','2'), false))"
)


TEXTS_OK = (
    "(coalesce(json_type(x, '$.headline') = 'VARCHAR' and regexp_matches(x->>'$.headline', '^\\$|^Shares|^[A-Z0-9]')"
    " and json_type(x, '$.sentiment') = 'VARCHAR', false))"
)


def every(test: str, items: str) -> str:
    return f"len(list_filter({items}, lambda x: not {test})) = 0"


def reason(items: str, strict: bool) -> str:
    last = f"when not ({every(SENTIMENT_OK, items)}) then 'bad_sentiment'" if strict else ""
    return (
        f"case when not json_valid(t) then 'not_json' when {items} is null then 'wrong_shape'"
        f" when not ({every(chr(40) + 'coalesce(json_type(x) = ' + text('OBJECT') + ', false))', items)}) then 'item_not_object'"
        f" when not ({every(KEYS_OK, items)}) then 'wrong_keys'"
        f" when not ({every(HEADLINE_OK, items)}) then 'bad_headline' {last} else 'accepted' end"
    )


def flattened(gated: str) -> str:
    return f"""select prompt_id, attempt, pos, it->>'$.headline' as headline, it->>'$.sentiment' as sentiment from (
 select prompt_id, attempt, unnest(range(len(items)))::bigint as pos, unnest(items) as it from {gated} where ok)"""


CTES: dict[str, str] = {
    "headlines": f"""
select d.doc_id as row_id, case when d.doc_id % 5 = 0 then 'validation' else 'train' end as split,
 case when l.toxic = 1 then 0 when l.quality = 1 then 1 else 2 end as label,
 concat(case when d.doc_id % 7 = 0 then concat('https://x.example/$ABC/', d.doc_id, ' ') else '' end,
  case when d.doc_id % 4 = 0 then '' else concat('$', {letters('d.doc_id % 97')}, ' - ') end, d.text) as text
from documents d join labels l on d.doc_id = l.doc_id""",
    "requests": f"""
select prompt_id, {pick(TEMPLATES, 'prompt_id')} as template, {pick(MODELS, 'prompt_id')} as model
from (select distinct conv_id as prompt_id from conversations)""",
    "shapes": f"""
select conv_id as prompt_id, turn as attempt, (conv_id * 7 + turn) % 12 as v,
 concat('{{"headline": ', to_json(text)::varchar, ', "sentiment": "1"}}') as a,
 concat('{{"headline": "Shares of ', {letters('conv_id % 29')}, ' fall", "sentiment": "0"}}') as b,
 concat('{{"headline": "Market flat ', conv_id, '", "sentiment": 2}}') as c
from conversations where role = 'assistant'""",
    "completions": """
select prompt_id, attempt, case v
 when 0 then concat('[', a, ', ', b, ', ', c, ']')
 when 1 then concat('```json', chr(10), '[', a, ', ', b, ', ', c, ']', chr(10), '```')
 when 2 then concat('  JSON [', a, ', ', b, '] ')
 when 3 then a
 when 4 then concat('Sure!', chr(10), '```', chr(10), '[', a, ', ', c, ']', chr(10), '``` done')
 when 5 then '[{"headline": "2024 1234", "sentiment": "1"}]'
 when 6 then concat('[', a, ', {"headline": "Odd", "sentiment": "9"}]')
 when 7 then concat('[', a, ', {"headline": "Extra", "sentiment": "1", "why": "x"}]')
 when 8 then concat('[', a, ', ', substr(b, 1, 20))
 when 9 then '[]'
 when 10 then concat('[', a, ', 7]')
 else concat('```json', chr(10), '[', a, ']') end as raw
from shapes""",
    "cleaned": f"""
select prompt_id, attempt, case when lower(substr(t, 1, 4)) = 'json' then {strip('substr(t, 5)')} else t end as t from (
 select prompt_id, attempt, case when len(ps) >= 3 then {strip('ps[2]')} when len(ps) = 2 then raw
  else {strip('raw')} end as t from (select *, string_split(raw, '```') as ps from completions))""",
    "listed": """
select *, case when json_valid(t) and json_type(t) = 'ARRAY' then t::json::json[] end as listed,
 case when json_valid(t) and json_type(t) = 'ARRAY' then t::json::json[]
      when json_valid(t) and json_type(t) = 'OBJECT' then [t::json] end as either from cleaned""",
    "strict": f"""
select prompt_id, attempt, listed as items,
 coalesce({every(f'({KEYS_OK} and {HEADLINE_OK} and {SENTIMENT_OK})', 'listed')}, false) as ok from listed""",
    "lenient": f"""
select prompt_id, attempt, either as items,
 coalesce({every(f'({KEYS_OK} and {HEADLINE_OK})', 'either')}, false) as ok from listed""",
    "custom": f"""
select prompt_id, attempt, either as items,
 coalesce({every(f'({KEYS_OK} and {TEXTS_OK})', 'either')}, false) as ok from listed""",
    "examples_custom": flattened("custom"),
    "examples": flattened("strict"),
    "examples_lenient": flattened("lenient"),
    "named": f"select prompt_id, {model_name('model')} as model, template as prompt from requests",
    "datasets": "select n.model, n.prompt, e.* from examples e join named n on e.prompt_id = n.prompt_id",
    "first_valid": """
select prompt_id, min(attempt) as attempt, arg_min(len(items), attempt) as n_items
from strict where ok group by prompt_id""",
    "pool": r"""
select row_id, split as pool, ticker from (
 select *, nullif(regexp_extract(regexp_replace(text, 'https?://\S+', '', 'g'), '\$([A-Z]+)', 1), '') as ticker
 from headlines) where ticker is not null""",
    "pool_pos": f"""
select pool, ticker, count(*) over (partition by pool) as total,
 row_number() over (partition by pool order by {hash60("'42'", "'row'", 'row_id')}, row_id) - 1 as ord from pool""",
    "train_pos": f"""
select label, text, row_number() over (partition by label order by {hash60("'42'", "'row'", 'row_id')}, row_id) - 1 as ord
from headlines where split = 'train'""",
    "label_sizes": "select label, count(*) as n from headlines where split = 'train' group by label",
    "shots": f"""
select prompt_id, pos, text, label from (
 select r.prompt_id, s.label, {hash60("'42'", 'r.prompt_id', 's.label', "'row'")} % s.n as ord,
  row_number() over (partition by r.prompt_id order by
   -ln(({hash60("'42'", 'r.prompt_id', 's.label', "'race'")} + 1)::double / 1152921504606846976.0::double) / s.n, s.label) - 1 as pos
 from requests r, label_sizes s where contains(r.template, 'few-shot'))
join train_pos using (label, ord) where pos < 3""",
    "asked": """
select prompt_id, case when contains(template, 'train-time-info') then 'train' else 'validation' end as pool
from requests where contains(template, 'time-info')""",
    "sized": """
select prompt_id, pool, total as n from asked join (select pool, count(*) as total from pool group by pool) using (pool)""",
    "subset": f"""
select prompt_id, pool, t1, case when t2 = t1 then n - 1 else t2 end as t2 from (
 select *, {hash60("'42'", 'prompt_id', 'n - 2', "'ticker'")} % (n - 1) as t1,
  {hash60("'42'", 'prompt_id', 'n - 1', "'ticker'")} % n as t2 from sized)""",
    "worepl": f"""
select prompt_id, row_number() over (partition by prompt_id order by {hash60("'42'", 'prompt_id', 'ord', "'order'")}, ord) - 1 as slot, ticker
from (select prompt_id, pool, unnest([t1, t2]) as ord from subset) join pool_pos using (pool, ord)""",
    "repl": f"""
select prompt_id, slot, ticker from (
 select prompt_id, pool, slot, {hash60("'42'", 'prompt_id', 'slot', "'ticker'")} % n as ord
 from (select *, unnest([0, 1]) as slot from sized)) join pool_pos using (pool, ord)""",
    "ticker_texts": """
select r.prompt_id, coalesce(t.stock_ticker, '') as stock_ticker from requests r left join (
 select prompt_id, string_agg('$' || ticker, ', ' order by slot) as stock_ticker from worepl group by prompt_id) t
on r.prompt_id = t.prompt_id""",
    "shot_texts": """
select prompt_id,
 concat('[', chr(10), string_agg(concat('  {', chr(10), '    "headline": ', to_json(text)::varchar, ',', chr(10),
  '    "sentiment": ', label, chr(10), '  }'), ',' || chr(10) order by pos), chr(10), ']') as examples,
 concat('[', chr(10), string_agg(concat('  {', chr(10), '    "x": ', to_json(text)::varchar, ',', chr(10),
  '    "y": ', label, chr(10), '  }'), ',' || chr(10) order by pos), chr(10), ']') as examples_xy
from shots group by prompt_id""",
    "inputs": """
select r.prompt_id, r.template, coalesce(s.examples, '') as examples, t.stock_ticker
from requests r join ticker_texts t on r.prompt_id = t.prompt_id left join shot_texts s on r.prompt_id = s.prompt_id""",
    "rendered": f"select *, {rendered()} as prompt from inputs",
    "templates": f"select * from (values {template_values()}) v(template, body, mode, pool, uses_bg)",
    "runs": """
select event_id as run_id, case when event_type in ('click', 'purchase') then '1 GPU' else '2 GPUs' end as gpu_config,
 ts as finished_at, 1000::bigint as num_examples, 1000 - user_id % 100 as rows_written,
 value + 1.0::double as total_time, 1000 / (value + 1.0::double) as throughput
from events""",
    "measures": """
select 'throughput' as measure, gpu_config, run_id, throughput as figure from runs
union all select 'total_time', gpu_config, run_id, total_time from runs""",
    "quartiles": """
select measure, gpu_config, count(*) as n, quantile_cont(figure, 0.25) as q1, quantile_cont(figure, 0.5) as median,
 quantile_cont(figure, 0.75) as q3 from measures group by measure, gpu_config""",
    "fenced": """
select m.*, q.n, q.q1, q.median, q.q3,
 m.figure between q.q1 - 1.5 * (q.q3 - q.q1) and q.q3 + 1.5 * (q.q3 - q.q1) as inside
from measures m join quartiles q on m.measure = q.measure and m.gpu_config = q.gpu_config""",
}

BODIES: dict[str, str] = {
    "scan_labeled": "select split, label, text from headlines",
    "scan_array_split": "select split, row_id, label, text from headlines",
    "scan_synthetic": """
select concat(model, '_', count(*) over (partition by model, prompt), '_prompt=', prompt, '.json') as dataset, headline, sentiment
from datasets""",
    "named_files": """
select concat(model, '_', count(*), '_prompt=', prompt, '.json') as file, count(*) as n from datasets group by model, prompt""",
    "write_roundtrip": "select model, prompt, prompt_id, attempt, pos, headline, sentiment from datasets",
    "committed_writes": """
select model, prompt, prompt_id, attempt, pos, headline, sentiment from datasets d where attempt = 1 or not exists (
 select 1 from datasets o where o.attempt = 1 and o.model is not distinct from d.model and o.prompt is not distinct from d.prompt)""",
    "missing_datasets": """
select model, prompt, prompt_id, attempt, pos, headline from datasets d where not exists (
 select 1 from datasets o where o.attempt = 1 and o.model = d.model and o.prompt = d.prompt)""",
    "run_metadata": f"""
select concat({model_name('model')}, '_prompt=', template, '_metadata.json') as file, count(*) as num_prompts,
 model, template as prompt, '3' as num_shots, '1.0' as temperature, '0.95' as top_p, '1024' as max_tokens, '1' as num_tickers
from requests group by model, template""",
    "strip_urls": r"""
select doc_id, regexp_replace(concat(case when doc_id % 7 = 0 then concat('https://x.example/$ABC/', doc_id, ' ') else '' end, text),
 'https?://\S+', '', 'g') as text from documents""",
    "ticker_pool": "select row_id, pool, ticker from pool",
    "ticker_freq": "select pool, ticker, count(*) as n from pool group by pool, ticker",
    "clean_completions": "select prompt_id, attempt, t as text from cleaned",
    "model_name": f"select prompt_id, model, {model_name('model')} as name from requests",
    "dataset_name": f"""
select model as asked_model, concat(name, '_', n, '_prompt=', template, '.json') as name, name as model,
 n as size, template from (
 select model, {model_name('model')} as name, template, count(*) as n from requests group by model, template)""",
    "classify_errors": """
select conv_id as prompt_id, turn as attempt,
 case (conv_id + turn) % 4 when 0 then 'retry_after' when 1 then case when contains(text, 'minute') then 'retry_after' else 'stop' end
 when 2 then case when contains(text, 'exceeded') and contains(text, 'limit') then
  case when contains(text, 'minute') then 'retry_after' else 'stop' end else 'retry' end end as action
from conversations""",
    "parse_completions": """
select prompt_id, attempt, json_valid(t) as is_json, case when json_valid(t)
  then case when json_type(t) = 'ARRAY' then json_array_length(t)::bigint else -1 end else -1 end as n_elements
from cleaned""",
    "gate_lenient": "select prompt_id, attempt, ok, case when ok then len(items) else -1 end as n_items from lenient",
    "gate_strict": "select prompt_id, attempt, ok, case when ok then len(items) else -1 end as n_items from strict",
    "reject_reasons": f"""
select 'lenient' as gate, reason, count(*) as n from (select {reason('either', False)} as reason from listed) group by reason
union all
select 'strict', reason, count(*) from (select {reason('listed', True)} as reason from listed) group by reason""",
    "gate_none": """
select prompt_id, attempt, json_valid(t) as ok, case when json_valid(t) then 1 else -1 end as n_items from cleaned""",
    "gate_custom": "select prompt_id, attempt, ok, case when ok then len(items) else -1 end as n_items from custom",
    "flatten_custom": "select * from examples_custom",
    "flatten_examples": "select * from examples",
    "flatten_lenient": "select * from examples_lenient",
    "template_catalog": """
select t.*, coalesce(r.n_requests, 0) as n_requests from templates t
left join (select template, count(*) as n_requests from requests group by template) r on t.template = r.template""",
    "ticker_draw_worepl": "select prompt_id, slot, ticker from worepl",
    "ticker_draw_repl": "select prompt_id, slot::bigint as slot, ticker from repl",
    "ticker_text": "select prompt_id, stock_ticker from ticker_texts",
    "fewshot_draw": "select prompt_id, pos, text, label from shots",
    "fewshot_json": "select prompt_id, examples, examples_xy from shot_texts",
    "render_prompts": "select prompt_id, template, prompt from rendered",
    "prompt_reuse": """
select md5(concat_ws(chr(31), template, examples, stock_ticker)) as prompt_key, template, count(*) as n_uses, min(prompt) as prompt
from rendered group by template, examples, stock_ticker""",
    "run_grid": """
select prompt_id, template, unnest(['llama3.1-8b', 'llama3.3-70b', 'qwen2.5:7b', 'qwen2.5:32b']) as model from requests""",
    "pending_prompts": """
select * from requests r where not exists (
 select 1 from strict s where s.ok and s.attempt = 1 and s.prompt_id = r.prompt_id)""",
    "next_batch": """
select * from requests r where not exists (
 select 1 from strict s where s.ok and s.attempt = 1 and s.prompt_id = r.prompt_id) order by prompt_id limit 25""",
    "align_aux": """
select r.*, a.opening from requests r join (
 select conv_id as prompt_id, arg_min(text, turn) as opening from conversations group by conv_id) a on r.prompt_id = a.prompt_id""",
    "first_valid": "select prompt_id, attempt, n_items from first_valid",
    "unfilled_prompts": """
select r.prompt_id, r.template, count(c.prompt_id) as tries from requests r left join completions c on c.prompt_id = r.prompt_id
where not exists (select 1 from first_valid f where f.prompt_id = r.prompt_id) group by r.prompt_id, r.template""",
    "quota_take": """
select prompt, prompt_id, attempt, n_items, before from (
 select n.prompt, s.prompt_id, s.attempt, len(s.items) as n_items,
  coalesce(sum(len(s.items)) over (partition by n.prompt order by s.prompt_id, s.attempt
   rows between unbounded preceding and 1 preceding), 0)::bigint as before
 from strict s join named n on s.prompt_id = n.prompt_id where s.ok) where before < 10""",
    "resume_union": """
select 0 as phase, model, prompt, null::bigint as prompt_id, null::bigint as attempt,
 row_number() over (partition by model, prompt order by prompt_id, attempt, pos) - 1 as pos, headline, sentiment
from datasets where attempt = 1
union all
select 1, d.model, d.prompt, d.prompt_id, d.attempt, d.pos, d.headline, d.sentiment from datasets d join (
 select s.prompt_id, s.attempt, n.model, n.prompt, coalesce(sum(len(s.items)) over (partition by n.model, n.prompt
  order by s.prompt_id, s.attempt rows between unbounded preceding and 1 preceding), 0) as before
 from strict s join named n on s.prompt_id = n.prompt_id where s.ok and s.attempt > 1) k
 on d.prompt_id = k.prompt_id and d.attempt = k.attempt left join (
 select model, prompt, count(*) as have from datasets where attempt = 1 group by model, prompt) h
 on h.model = k.model and h.prompt = k.prompt where k.before + coalesce(h.have, 0) < 4""",
    "apply_provider": """
select prompt_id, concat('[{"headline": "Prompt of ', length(prompt), ' characters", "sentiment": "2"}]') as raw,
 null::varchar as error from rendered""",
    "quota_rounds": """
select d.model, d.prompt, d.prompt_id, d.pos, d.headline, d.sentiment from datasets d join (
 select n.model, n.prompt, s.prompt_id, coalesce(sum(len(s.items)) over (partition by n.model, n.prompt order by s.prompt_id
  rows between unbounded preceding and 1 preceding), 0) as before
 from strict s join named n on s.prompt_id = n.prompt_id where s.ok and s.attempt = 1 and len(s.items) > 0) k
 on d.prompt_id = k.prompt_id where d.attempt = 1 and k.before < 6""",
    "generate_e2e": """
select n.model, r.template as prompt, r.prompt_id, 1::bigint as attempt, 0::bigint as pos,
 concat('P ', length(r.prompt), ' ', substr(md5(r.prompt), 1, 8)) as headline, '1' as sentiment
from rendered r join named n on r.prompt_id = n.prompt_id
qualify row_number() over (partition by n.model, r.template, headline order by r.prompt_id) = 1""",
    "retry_rounds": "select prompt_id, attempt, n_items from first_valid",
    "schedule_requests": """
with e as (
 select event_id, event_type, epoch_us(ts) as ready,
  row_number() over (partition by event_type order by epoch_us(ts), event_id) - 1 as place
 from events where ts is not null
), s as (
 select *, place * 1200000000 + max(ready - place * 1200000000) over (
  partition by event_type order by ready, event_id rows between unbounded preceding and current row) as start from e
)
select event_id, event_type, place, ready, start, start - ready as wait from s""",
    "resumed_rounds": "select prompt_id, attempt, n_items from first_valid",
    "letter_filter": "select doc_id, text as headline from documents where regexp_matches(text, '[a-zA-Z]')",
    "dedup_headline": """
select * from datasets qualify row_number() over (partition by model, prompt, headline order by prompt_id, attempt, pos) = 1""",
    "dataset_counts": "select model, prompt, count(*) as n from datasets group by model, prompt",
    "sample_per_dataset": f"""
select * from datasets where regexp_matches(headline, '[a-zA-Z]') qualify row_number() over (
 partition by model, prompt order by {hash60("'42'", "'sample'", 'prompt_id', 'attempt', 'pos')}, prompt_id, attempt, pos) <= 3""",
    "curate_e2e": f"""
select * from (
 select * from datasets qualify row_number() over (partition by model, prompt, headline order by prompt_id, attempt, pos) = 1)
where regexp_matches(headline, '[a-zA-Z]') qualify row_number() over (
 partition by model, prompt order by {hash60("'42'", "'sample'", 'prompt_id', 'attempt', 'pos')}, prompt_id, attempt, pos) <= 5""",
    "stream_curate": "select distinct model, prompt, headline from datasets",
    "throughput": """
select run_id, num_examples, round(throughput, 6) as throughput, round(rows_written / total_time, 6) as written_per_second from runs""",
    "benchmark_union": """
select run_id, num_examples, total_time, gpu_config, case when gpu_config = '2 GPUs' then rows_written else -1 end as rows_written from runs""",
    "runs_ordered": """
select gpu_config, row_number() over (partition by gpu_config order by finished_at, run_id) as run_no, run_id, total_time
from runs order by gpu_config, run_no""",
    "benchmark_files": """
select gpu_config, row_number() over (partition by gpu_config order by finished_at, cast(run_id as varchar)) as run_no, run_id,
 finished_at, num_examples from runs""",
    "run_grid_modes": """
select prompt_id, template, 'm' as model, case when contains(template, 'zero-shot') then 'zero-shot' else 'few-shot' end as mode
from requests""",
    "benchmark_summary": """
select gpu_config, """ + ", ".join(
        f"round({fn}({m}), 6) as {m}_{name}"
        for m in ("throughput", "total_time")
        for fn, name in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max"))
    ) + " from runs group by gpu_config",
    "benchmark_box": """
select measure, gpu_config, n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
 round(min(figure) filter (inside), 6) as whisker_low, round(max(figure) filter (inside), 6) as whisker_high,
 count(*) filter (not inside) as n_outliers
from fenced group by measure, gpu_config, n, q1, median, q3""",
    "benchmark_outliers": "select measure, gpu_config, run_id, round(figure, 6) as figure from fenced where not inside",
}


def compose(body: str) -> str:
    """Put the CTEs a query uses, directly or not, in front of it."""
    used: set[str] = set()

    def visit(sql: str) -> None:
        for name in re.findall(r"(?:from|join|,)\s+(\w+)", sql):
            if name in CTES and name not in used:
                used.add(name)
                visit(CTES[name])

    visit(body)
    if not used:
        return body.strip()
    parts = ", ".join(f"{name} as ({sql})" for name, sql in CTES.items() if name in used)
    return f"with {parts} {body.strip()}"


BODIES["summary_csv"] = BODIES["benchmark_summary"]
ORACLE: dict[str, str] = {name: compose(body) for name, body in BODIES.items()}

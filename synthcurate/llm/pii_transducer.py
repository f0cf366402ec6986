"""Personal data, also where it is disguised, with spans in the source text.

Plain detectors find e-mail and IP addresses, card and phone numbers. For
disguised ones a chain of transducers rewrites the text while every output
character keeps the span of the source characters it stands for:

1. characters: full-width and other compatibility forms, look-alike letters of
   other alphabets next to Latin letters, foreign digits; invisible characters
   go;
2. words: bracketed or spelled "at" and "dot" become their signs, runs of
   spelled digits become digits, a spelled plus before digits its sign.

The detectors run again on the output; a match whose source differs from it is
mapped back and added. Only lines that a transducer may change are rewritten;
no pattern goes across a line end, so nothing is lost by that.

Defined results: offsets are code points, ends exclusive; NULL is an empty text.
Matches of one kind are leftmost and do not overlap; one that fails its check
(address part above 255, Luhn sum, number of digits) is dropped. An added span
that a plain span of the same kind covers is not repeated. All patterns take
time in proportion to the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column

from .common import text_udf

KINDS = ("email", "ip", "card", "phone")
FOUND = "struct<base:array<string>,spans:array<string>,counts:array<bigint>>"
_FOUND = pa.struct([("base", pa.list_(pa.string())), ("spans", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits is entered at its start only: inside it no match can begin
# that would not have begun before.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, str]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from the sign outwards: a search from the left
    would try every start of a long run."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            low = domain.end()
            yield start, low, "email"
        else:
            low = max(low, at + 1)
        at = text.find("@", low)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def detect(text: str) -> list[Span]:
    found = list(emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return found


# Letters of other alphabets that look like Latin ones.
_LOOKALIKE = dict(zip(
    "АВЕЅІЈКМНОРСТХУаеіјорсухѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυιϲ",
    "ABESIJKMHOPCTXYaeijopcyxsdhqwABEZHIKMNOPTYXavopuic",
))
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
# Digit words of four languages.
_WORDS = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei zwo deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
_DIGIT = {w: d for d, ws in _WORDS.items() for w in ws.split()}
_NUMBER_WORDS = "|".join(sorted(_DIGIT, key=len, reverse=True))
# Latin-1 letters belong to ordinary text and are no disguise.
_ODD = re.compile(r"[\u0300-\U0010ffff\u00ad]")
_SIGN = {"at": "@", "arroba": "@", "dot": ".", "punkt": ".", "point": ".", "punto": "."}
_DOT, _AT = "dot|punkt|point|punto", "at|arroba"
_BRACKETED = re.compile(rf" ?[(\[{{<] ?({_AT}|{_DOT}) ?[)\]}}>] ?", re.IGNORECASE)
# Bare words are signs only in the shape of a whole address with a spelled dot.
_BARE = re.compile(
    rf"[a-z0-9._%+-]{{1,64}}(?:@|[ _-](?:{_AT})[ _-])[a-z0-9-]{{1,63}}(?:\.[a-z0-9-]{{1,63}}){{0,4}}[ _-](?:{_DOT})[ _-][a-z0-9-]{{1,63}}"
    rf"(?:(?:\.|[ _-](?:{_DOT})[ _-])[a-z0-9-]{{1,63}}){{0,4}}", re.IGNORECASE,
)
_BARE_SIGN = re.compile(rf"[ _-]({_AT}|{_DOT})[ _-]", re.IGNORECASE)
_BETWEEN = r"[ .,()-]{1,3}"
_SPELLED = re.compile(
    rf"(?:\bplus[ ,-]{{1,2}})?(?:\b(?:{_NUMBER_WORDS})\b|[0-9])"
    rf"(?:{_BETWEEN}(?:{_NUMBER_WORDS}|{_DOT})\b|[ .,()-]{{0,3}}[0-9])+", re.IGNORECASE,
)
_SPELLED_PART = re.compile(rf"(?:plus|{_DOT}|{_NUMBER_WORDS})(?![A-Za-z])", re.IGNORECASE)
# A bare "at" with dots in plain sight: before a domain, after a name of several parts.
_PLAIN_AT = re.compile(
    rf"(?<![a-z0-9._%+-])[a-z][a-z0-9]{{0,63}}(?:[._+][a-z][a-z0-9]{{0,63}}){{1,4}}([ _-](?:{_AT})[ _-])(?:[a-z0-9-]{{1,63}}\.){{1,4}}[a-z]{{2,24}}(?![a-z0-9-])",
    re.IGNORECASE,
)


def plain_of(c: str) -> str:
    """What an odd character becomes."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKE:
        return _LOOKALIKE[c]
    if c.isdecimal():
        return str(unicodedata.decimal(c))
    new = unicodedata.normalize("NFKC", c)
    return new if new.isascii() and len(new) <= 3 else c


def _changed() -> str:
    """All characters that ``plain_of`` changes, as ranges of a pattern."""
    places = [n for n in range(0x300, 0x110000) if (c := chr(n)) in _LOOKALIKE or c in _INVISIBLE or c.isdecimal() or unicodedata.decomposition(c)]
    places = [0xAD, *(n for n in places if plain_of(chr(n)) != chr(n))]
    starts = [n for n, before in zip(places, [-1, *places]) if n != before + 1]
    ends = [n for n, after in zip(places, [*places[1:], -1]) if n != after - 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


#: What the transducers need to change a line; each alternative is implied by one of them.
_CHANGED = re.compile(f"[{_changed()}]")
_SIGN_WORD = re.compile(rf"[(\[{{<] ?(?:{_AT}|{_DOT}) ?[)\]}}>]|[ _-](?:{_DOT})[ _-]", re.IGNORECASE)
_NUMBER = re.compile(rf"\b(?:{_NUMBER_WORDS})\b", re.IGNORECASE)


class Tape:
    """Text whose characters know the source span they stand for."""

    __slots__ = ("text", "starts", "ends")

    def __init__(self, text: str, starts: list[int], ends: list[int]) -> None:
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, source: str, start: int, end: int) -> Tape:
        return cls(source[start:end], list(range(start, end)), list(range(start + 1, end + 1)))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace stretches; all characters of a replacement stand for its whole stretch."""
        out, starts, ends, at = [], [], [], 0
        for low, high, new in edits:
            out += (self.text[at:low], new)
            starts += self.starts[at:low] + [self.starts[low]] * len(new)
            ends += self.ends[at:low] + [self.ends[high - 1]] * len(new)
            at = high
        out.append(self.text[at:])
        return Tape("".join(out), starts + self.starts[at:], ends + self.ends[at:])


def plain_characters(tape: Tape) -> Tape:
    edits = []
    for m in _ODD.finditer(tape.text):
        c = m.group()
        new = plain_of(c)
        if new != c:
            edits.append((m.start(), m.end(), new))
    return tape.rewrite(edits) if edits else tape


def signs(tape: Tape) -> Tape:
    edits = [(m.start(), m.end(), _SIGN[m[1].lower()]) for m in _BRACKETED.finditer(tape.text)]
    tape = tape.rewrite(edits) if edits else tape
    edits = []
    for m in _BARE.finditer(tape.text):
        edits += [(s.start(), s.end(), _SIGN[s[1].lower()]) for s in _BARE_SIGN.finditer(tape.text, m.start(), m.end())]
    tape, edits = tape.rewrite(edits) if edits else tape, []
    for m in _PLAIN_AT.finditer(tape.text):
        edits.append((m.start(1), m.end(1), "@"))
    return tape.rewrite(edits) if edits else tape


def spelled_digits(tape: Tape) -> Tape:
    """Runs with at least three spelled digits; the space between digits goes."""
    edits = []
    for m in _SPELLED.finditer(tape.text):
        parts = list(_SPELLED_PART.finditer(tape.text, m.start(), m.end()))
        if sum(p.group().lower() in _DIGIT for p in parts) < 3:
            continue
        at = None
        for p in parts:
            word = p.group().lower()
            new = "+" if word == "plus" else _DIGIT.get(word, ".")
            gap = at is not None and not tape.text[at : p.start()].strip(" ,-")
            edits.append((at if gap else p.start(), p.end(), new))
            at = p.end()
    return tape.rewrite(edits) if edits else tape


def may_hide(line: str) -> bool:
    return bool(
        _SIGN_WORD.search(line) or not line.isascii() and _CHANGED.search(line) or _PLAIN_AT.search(line)
        or sum(1 for _ in islice(_NUMBER.finditer(line), 3)) == 3
    )


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Whole lines that a transducer may change. No pattern goes across a line end."""
    low = 0
    for line in text.split("\n"):
        if may_hide(line):
            yield low, low + len(line)
        low += len(line) + 1


def disguised(text: str) -> list[Span]:
    found = []
    for low, high in stretches(text):
        source = Tape.of(text, low, high)
        tape = plain_characters(source)
        for step in (signs, spelled_digits):
            tape = step(tape)
            if tape is source:
                continue
            for start, end, kind in detect(tape.text):
                a, b = tape.starts[start], tape.ends[end - 1]
                if text[a:b] != tape.text[start:end]:
                    found.append((a, b, kind))
    return found


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans, each in order."""
    base = detect(text)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    covered = lambda s: any(b[2] == s[2] and b[0] <= s[0] and s[1] <= b[1] for b in base)
    hidden = disguised(text)
    added = {s for s in hidden if not covered(s)}
    # Of added spans of a kind that overlap, the widest stands.
    kept: list[Span] = []
    for s in sorted(added, key=lambda s: (s[0] - s[1], s)):
        if not any(k[2] == s[2] and s[0] < k[1] and k[0] < s[1] for k in kept):
            kept.append(s)
    return sorted(base, key=order), sorted([*base, *kept], key=order)


def _each(raw: bytes) -> dict:
    base, every = find(raw.decode())
    names = lambda spans: [f"{k}:{s}:{e}" for s, e, k in spans]
    return {"base": names(base), "spans": names(every), "counts": [sum(k == kind for _, _, k in base) for kind in KINDS]}


def personal_data(text: Column) -> Column:
    """A column (base, spans, counts): spans as kind:start:end, plain counts by kind."""
    return text_udf(_each, _FOUND, FOUND)(text)

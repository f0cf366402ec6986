"""Parsing and gating of cleaned completions with the Variant type.

The steps are SQL expressions over the columns ``text``, ``pair``, ``value``
and ``candidates``, which ``operators/gate.py`` adds one after the other. A
completion is parsed once, and its items keep every key and every value type
until the gate has looked at them. ``from_json`` into a struct would not do:
it drops extra keys and turns ``1.0`` or ``true`` into text.

What the items must look like is a ``Gate``: the fields with their types and
tests. Gate, reject reasons, example columns and the instructions of a prompt
all follow from it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

# Beyond these a value may be JSON although Variant cannot hold it.
MAX_BYTES = 16_000_000
MAX_DEPTH = 900

# [text, marker] as one JSON array. ``try_parse_json`` stops after the first
# complete value, so alone it accepts text with something behind the JSON. The
# marker is made from the text itself: whatever follows the value, or closes
# the array early, hides or moves it.
PAIR = """try_variant_get(try_parse_json(concat('[', text, ',"', md5(text), '"]')), '$', 'array<variant>')"""

# Nesting of a text that did not parse: only brackets are looked at, and only
# where there are enough of them.
_BRACKETS = r"regexp_replace(text, '[^\\[\\]{}]', '')"
_DEPTH = f"""aggregate(split({_BRACKETS}, ''), named_struct('now', 0, 'most', 0),
  (a, c) -> named_struct('now', a.now + CASE WHEN c IN ('[', '{{') THEN 1 WHEN c IN (']', '}}') THEN -1 ELSE 0 END,
                         'most', greatest(a.most, a.now + CASE WHEN c IN ('[', '{{') THEN 1 ELSE 0 END)), a -> a.most)"""

# The JSON value of ``text``, NULL unless it is one complete value. A text too
# large or too deep to tell is an error, not a reject.
VALUE = f"""CASE
  WHEN size(pair) = 2 AND try_variant_get(get(pair, 1), '$', 'string') = md5(text) THEN get(pair, 0)
  WHEN octet_length(text) > {MAX_BYTES} OR (octet_length({_BRACKETS}) > {MAX_DEPTH} AND {_DEPTH} > {MAX_DEPTH})
  THEN cast(raise_error(concat('completion too large or too deep to parse: ', octet_length(text), ' bytes, ', left(text, 80))) AS variant) END"""

# The items of a JSON list; an item that is no object is NULL, and the whole
# is NULL for anything but a list.
LISTED = "try_variant_get(value, '$', 'array<map<string,variant>>')"

# The same, with a single object taken as a list of one.
_SINGLE = "try_variant_get(value, '$', 'map<string,variant>')"
LISTED_OR_SINGLE = f"coalesce({LISTED}, CASE WHEN {_SINGLE} IS NOT NULL THEN array({_SINGLE}) END)"

# Tests of one item ``x``.
IS_OBJECT = "x IS NOT NULL"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Field:
    """A key of an item. ``kinds`` are the JSON types it may have (STRING,
    BIGINT, DOUBLE, BOOLEAN, OBJECT, ARRAY), any for none; ``pattern`` must be
    found in its text; ``allowed`` lists all texts it may have. ``type`` is the
    type of the example column."""

    name: str
    kinds: tuple[str, ...] = ()
    pattern: str | None = None
    allowed: tuple[str, ...] = ()
    type: str = "string"

    @property
    def item(self) -> str:
        return f"x[{_text(self.name)}]"

    def text(self) -> str:
        return f"try_variant_get({self.item}, '$', 'string')"

    def test(self) -> str:
        tests = []
        if self.kinds:
            # schema_of_variant tells the inner types of objects and arrays too.
            tests.append(f"split(schema_of_variant({self.item}), '<')[0] IN ({', '.join(map(_text, self.kinds))})")
        if self.pattern is not None:
            tests.append(f"{self.text()} RLIKE {_text(self.pattern)}")
        if self.allowed:
            tests.append(f"{self.text()} IN ({', '.join(map(_text, self.allowed))})")
        return " AND ".join(tests) or "true"


@dataclass(frozen=True)
class Gate:
    """Items with exactly these fields. ``single`` takes a lone object as a list of one."""

    fields: tuple[Field, ...]
    single: bool = False

    def candidates(self) -> str:
        return LISTED_OR_SINGLE if self.single else LISTED

    def keys(self) -> str:
        return " AND ".join([f"size(x) = {len(self.fields)}", *(f"map_contains_key(x, {_text(f.name)})" for f in self.fields)])

    def accepts(self) -> str:
        return all_items(self.keys(), *(f.test() for f in self.fields))

    def examples(self) -> str:
        """array<struct> of items that passed, a column for each field."""
        parts = ", ".join(f"{_text(f.name)}, try_variant_get({f.item}, '$', '{f.type}')" for f in self.fields)
        return f"transform(candidates, x -> named_struct({parts}))"

    def reject_reason(self) -> str:
        """Name of the first failed test, ``accepted`` where none fails."""
        steps = [(IS_OBJECT, "item_not_object"), (self.keys(), "wrong_keys"), *((f.test(), f"bad_{f.name}") for f in self.fields)]
        tests = " ".join(f"WHEN NOT {all_items(test)} THEN {_text(name)}" for test, name in steps)
        return f"CASE WHEN value IS NULL THEN 'not_json' WHEN candidates IS NULL THEN 'wrong_shape' {tests} ELSE 'accepted' END"

    def instructions(self) -> str:
        """What a completion must look like, for a prompt."""
        return (
            "Answer with a JSON list. Each element is an object with exactly these keys and value types: "
            + json.dumps({f.name: f.type for f in self.fields})
        )


def all_items(*tests: str) -> str:
    """True where every item passes; the empty list does, a missing one not."""
    return f"coalesce(forall(candidates, x -> coalesce({' AND '.join(tests)}, false)), false)"


# A headline has a letter; the strict gate takes lists only and three labels.
LENIENT = Gate((Field("headline", ("STRING",), "[a-zA-Z]"), Field("sentiment")), single=True)
STRICT = Gate((Field("headline", ("STRING",), "[a-zA-Z]"), Field("sentiment", ("STRING", "BIGINT"), allowed=("0", "1", "2"))))


def gate_of(choice: Gate | bool | None) -> Gate | None:
    """``True`` is the strict gate, ``False`` the lenient one, ``None`` none."""
    return {True: STRICT, False: LENIENT}[choice] if isinstance(choice, bool) else choice

"""Completions -> cleaned -> parsed -> gated -> example rows.

``strict`` names the gate everywhere: True or False for the two of this
package, a ``Gate`` of your own, or None for no gate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthcurate.functions import completion as sql
from synthcurate.functions.completion import Gate, gate_of
from synthcurate.functions.text import fenced_part, without_json_tag


def cleaned(completions: DataFrame, clean: bool = True) -> DataFrame:
    """Add ``text``, the part of ``raw`` that should be JSON."""
    if not clean:
        return completions.withColumn("text", F.col("raw"))
    parts = completions.withColumn("text", fenced_part(F.col("raw")))
    return parts.withColumn("text", without_json_tag(F.col("text")))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A filter above a projection is moved below it together with a copy of the
    expressions it uses, which would parse every completion again. Filters do
    not move below a generator, so the columns come out of a one-row ``inline``.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def _valued(completions: DataFrame, clean: bool) -> DataFrame:
    """Add ``text`` and its JSON ``value``."""
    return cleaned(completions, clean).selectExpr("*", f"{sql.PAIR} AS pair").selectExpr("* EXCEPT (pair)", f"{sql.VALUE} AS value")


def parsed(completions: DataFrame, strict: bool | Gate = True, clean: bool = True) -> DataFrame:
    """Add ``text``, its JSON ``value`` (Variant, NULL if it is not JSON) and
    ``candidates``, the items as the gate will see them."""
    rows = _valued(completions, clean).selectExpr("*", f"{gate_of(strict).candidates()} AS candidates")
    return _once(rows, value=F.col("value"), candidates=F.col("candidates"))


def gate(
    completions: DataFrame, strict: bool | Gate | None = True, clean: bool = True,
    checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replace ``raw`` by ``items``, the examples of an accepted completion
    (NULL for a rejected one), and ``n_items``.

    ``checks`` are further named tests over ``items``; a completion must pass
    all of them. Without a gate every JSON value is accepted as one item whose
    ``value`` is its JSON text.
    """
    spec = gate_of(strict)
    if spec is None:
        items = "CASE WHEN value IS NOT NULL THEN array(named_struct('value', to_json(value))) END"
        out = _valued(completions, clean).selectExpr("* EXCEPT (raw, text, value)", f"{items} AS items")
    else:
        out = _valued(completions, clean).selectExpr("*", f"{spec.candidates()} AS candidates").selectExpr(
            "* EXCEPT (raw, text, value, candidates)", f"CASE WHEN {spec.accepts()} THEN {spec.examples()} END AS items"
        )
    for check in (checks or {}).values():
        out = out.withColumn("items", F.when(F.coalesce(check, F.lit(False)), F.col("items")))
    n_items = F.expr("CASE WHEN items IS NOT NULL THEN cast(size(items) AS bigint) END")
    return _once(out, items=F.col("items"), n_items=n_items)


def item_names(gated: DataFrame) -> list[str]:
    """The fields of the items."""
    kind = gated.schema["items"].dataType
    assert isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)
    return kind.elementType.fieldNames()


def flatten(gated: DataFrame) -> DataFrame:
    """One row per example with its position ``pos`` in the completion."""
    others = [c for c in gated.columns if c not in ("items", "n_items")]
    rows = gated.select(*others, F.posexplode("items").alias("pos", "item"))
    return rows.select(*others, F.col("pos").cast("bigint").alias("pos"), *[F.col("item")[n].alias(n) for n in item_names(gated)])


def reasons(completions: DataFrame, strict: bool | Gate = True, clean: bool = True) -> DataFrame:
    """Add ``reason``: why the gate rejects a completion, or ``accepted``."""
    out = _valued(completions, clean).selectExpr("*", f"{gate_of(strict).candidates()} AS candidates")
    return _once(out, reason=F.expr(gate_of(strict).reject_reason())).drop("value", "candidates")


def reason_counts(completions: DataFrame, gates: Mapping[str, bool | Gate], clean: bool = True) -> DataFrame:
    """(gate, reason, n) for several named gates; each completion is parsed once."""
    rows = _once(_valued(completions, clean), value=F.col("value")).select("value")
    named = [
        F.struct(F.lit(name).alias("gate"), F.expr(gate_of(g).candidates()).alias("candidates")) for name, g in gates.items()
    ]
    rows = rows.select("value", F.inline(F.array(*named)))
    reason = F.lit(None).cast("string")
    for name, g in gates.items():
        reason = F.when(F.col("gate") == name, F.expr(gate_of(g).reject_reason())).otherwise(reason)
    return rows.select("gate", reason.alias("reason")).groupBy("gate", "reason").agg(F.count("*").alias("n"))

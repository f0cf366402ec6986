from pyspark.sql import functions as F

from synthcurate import CurationSpec, curate

TWO = '[{"headline": "a", "sentiment": "1"}, {"headline": "b", "sentiment": "0"}]'


def test_hooks_and_options(rows):
    df = rows([("d", 1, 1, TWO), ("d", 2, 1, TWO), ("e", 3, 1, '{"headline": "c", "sentiment": "7"}')],
              "ds string, prompt_id long, attempt long, raw string")
    assert sorted(r.headline for r in curate(df).collect()) == ["a", "b"]
    assert curate(df, CurationSpec(deduplicate=False)).count() == 4
    assert sorted(r.headline for r in curate(df, CurationSpec(strict=False, by=("ds",))).collect()) == ["a", "b", "c"]
    spec = CurationSpec(
        checks={"two": F.size("items") == 2},
        each_output=lambda g: g.withColumn("source", F.concat("ds", F.lit("!"))),
        all_results=lambda x: x.withColumn("headline", F.upper("headline")).drop("ds"),
    )
    out = curate(df, spec)
    assert sorted((r.headline, r.source, r.prompt_id) for r in out.collect()) == [("A", "d!", 1), ("B", "d!", 1)]

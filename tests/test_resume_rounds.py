import pytest
from pyspark.sql import functions as F

from synthcurate.operators import rounds
from synthcurate.session import scratch_path

GOOD = '[{"headline": "Fine %d", "sentiment": "1"}]'


def completions(spark):
    # prompt p is answered well in round (p % 4) + 1, badly before
    rows = [(p, a, GOOD % p if a == p % 4 + 1 else "no json") for p in range(40) for a in range(1, 6)]
    return spark.createDataFrame(rows, "prompt_id long, attempt long, raw string")


def counting(spark, answers, asked, fail_at=None):
    inner = rounds.replay_completer(answers)

    def complete(prompts, round_no, path):
        if round_no == fail_at:
            raise RuntimeError("stopped")
        asked.extend((round_no, r.prompt_id) for r in prompts.select("prompt_id").collect())
        return inner(prompts, round_no, path)

    return complete


def test_a_stopped_run_goes_on(spark):
    answers = completions(spark)
    prompts = spark.range(40).select(F.col("id").alias("prompt_id"), F.concat(F.lit("p"), F.col("id")).alias("prompt"))
    whole, _ = rounds.run_rounds(prompts, rounds.replay_completer(answers), max_rounds=5)
    want = sorted(tuple(r) for r in whole.select("prompt_id", "attempt", "n_items").collect())

    path = scratch_path(spark, "resume")
    asked = []
    with pytest.raises(Exception):
        rounds.run_rounds(prompts, counting(spark, answers, asked, fail_at=3), max_rounds=5, path=path)
    assert {r for r, _ in asked} == {1, 2}
    accepted_before = {p for p in range(40) if p % 4 + 1 <= 2}
    asked.clear()
    done, open_prompts = rounds.run_rounds(prompts, counting(spark, answers, asked), max_rounds=5, path=path)
    assert min(r for r, _ in asked) == 3
    assert not accepted_before & {p for _, p in asked}
    assert sorted(tuple(r) for r in done.select("prompt_id", "attempt", "n_items").collect()) == want
    assert open_prompts.count() == 0
    # a finished run asks nothing more
    asked.clear()
    rounds.run_rounds(prompts, counting(spark, answers, asked), max_rounds=5, path=path)
    assert asked == []


def test_another_request_set_is_an_error(spark):
    answers = completions(spark)
    prompts = spark.range(40).select(F.col("id").alias("prompt_id"), F.concat(F.lit("p"), F.col("id")).alias("prompt"))
    path = scratch_path(spark, "resume-other")
    rounds.run_rounds(prompts, rounds.replay_completer(answers), max_rounds=1, path=path)
    with pytest.raises(ValueError, match="another request set"):
        rounds.run_rounds(prompts.filter("prompt_id < 39"), rounds.replay_completer(answers), max_rounds=2, path=path)
    # the same set in another order and partitioning is the same set
    rounds.run_rounds(prompts.repartition(3).orderBy(F.desc("prompt_id")), rounds.replay_completer(answers), max_rounds=2, path=path)


def test_query(spark):
    from synthcurate.plans.queries import QUERIES

    got = QUERIES["resumed_rounds"](spark, "/root/testdata/sf0.001")
    want = QUERIES["retry_rounds"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_checks_reject_in_rounds(spark):
    answers = completions(spark)
    prompts = spark.range(40).select(F.col("id").alias("prompt_id"), F.concat(F.lit("p"), F.col("id")).alias("prompt"))
    odd = {"odd_headline": F.exists("items", lambda x: F.col("prompt_id") % 2 == 1)}
    done, left = rounds.run_rounds(prompts, rounds.replay_completer(answers), max_rounds=5, checks=odd)
    assert {r.prompt_id for r in done.collect()} == {p for p in range(40) if p % 2 == 1}
    assert left.count() == 20

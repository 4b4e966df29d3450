"""Masks of configured models, mergeable states of repeats, sources that fall back, and the state of the judging stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillon.functions.text import PLACEHOLDER
from quillon.operators import candidates as C
from quillon.operators import incremental as I
from quillon.operators import masks as M
from quillon.operators import repeats as A
from quillon.streaming.incremental import judge_stream

CANDIDATE = "sample_id string, model_type string, model_name string, response string"


def drawn(rng, n_models, n_samples):
    """Models, and candidates of samples: some missing, blank, placeholders, twice, or of a model that is not configured."""
    models = [("t", f"m{i}") for i in range(n_models)]
    rows = []
    for s in range(n_samples):
        for t, m in [*models, ("t", "other"), ("u", "m0")]:
            for _ in range(rng.choice([0, 1, 1, 2]) if s % 5 else 1):
                rows.append((str(s), t, m, rng.choice(["text", "text", "", None, PLACEHOLDER]) if s % 5 else "text"))
    rng.shuffle(rows)
    return models, rows


@pytest.mark.parametrize("n_models", [1, 5, 63, 64, 130])
def test_plans_by_masks_equal_sets(spark, n_models):
    rng = random.Random(n_models)
    models, rows = drawn(rng, n_models, 20)
    configured = spark.createDataFrame([*models, models[0]], "model_type string, model_name string")
    candidates = spark.createDataFrame(rows, CANDIDATE)
    samples = spark.createDataFrame([(str(s),) for s in range(22)], "sample_id string")  # two have no candidate
    have, good = {}, {}
    for s, t, m, r in rows:
        have.setdefault(s, set()).add((t, m))
        if (r or "").strip() not in ("", PLACEHOLDER):
            good.setdefault(s, set()).add((t, m))
    full = {s for s in have if set(models) <= have[s]}
    assert {r.sample_id for r in I.completed_samples(candidates, configured).collect()} == full
    assert {r.sample_id for r in I.incomplete_samples(samples, configured, candidates).collect()} == {str(s) for s in range(22)} - full
    plan = {tuple(r) for r in I.repair_plan(samples, configured, candidates).collect()}
    assert plan == {(str(s), *m) for s in range(22) for m in set(models) - good.get(str(s), set())}


def test_plans_by_masks_shuffle_once(spark):
    models, rows = drawn(random.Random(0), 4, 9)
    configured, candidates = spark.createDataFrame(models, "model_type string, model_name string"), spark.createDataFrame(rows, CANDIDATE)
    samples = candidates.select("sample_id")
    for df in (I.completed_samples(candidates, configured), I.incomplete_samples(samples, configured, candidates), I.repair_plan(samples, configured, candidates)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        full = df._jdf.queryExecution().executedPlan().toString()
        assert full.count("Exchange hashpartitioning") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_models_and_no_rows(spark):
    none = spark.createDataFrame([], "model_type string, model_name string")
    candidates = spark.createDataFrame([("1", "t", "m", "x")], CANDIDATE)
    samples = spark.createDataFrame([("1",), ("2",)], "sample_id string")
    assert I.repair_plan(samples, none, candidates).count() == 0 and I.incomplete_samples(samples, none, candidates).count() == 0
    assert I.completed_samples(candidates.filter("false"), spark.createDataFrame([("t", "m")], none.schema)).count() == 0
    assert M.model_masks(none, candidates.filter("false"))[0].count() == 0


RUN = "sample_id string, candidate_id string, candidate string, model_name string, judge string, repeat_idx int, ground_score double, aggregate_score double, label int, confidence double, passed boolean, notes string, penalties array<struct<rule_id: string, score: double>>, ground_output struct<checks: array<struct<rule_id: string>>, confidence: string>"


@pytest.mark.parametrize("by", [(), ("judge",)])
def test_states_merge_in_any_order(spark, by):
    rng = random.Random(4)
    maybe = lambda x: x if rng.random() < 0.7 else None
    rows = [
        (str(s), maybe(f"c{c}"), f"text {c}", maybe(f"m{run}"), rng.choice("jk"), run, maybe(float(rng.randrange(9))), maybe(rng.random()), maybe(rng.randrange(2)), maybe(0.5), maybe(rng.random() < 0.8), maybe(f"n{run}"), maybe([("R", float(run))]), maybe(([(f"r{run}",)], maybe("0.5"))))
        for s in range(3) for c in range(2) for run in range(5)
    ]
    runs = spark.createDataFrame(rows, RUN)
    whole = A.repeat_aggregate(runs, *by)
    states = [A.repeat_state(runs.filter(F.col("repeat_idx") == i), *by) for i in range(5)]
    one_by_one = states[0]
    for s in states[1:]:
        one_by_one = A.merge_states(one_by_one, s)
    others = A.merge_states(states[3], A.merge_states(states[4], states[0], states[2]), states[1])
    plain = lambda df: sorted(repr([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.select(whole.columns).collect())
    assert plain(A.finished_repeats(one_by_one)) == plain(A.finished_repeats(others)) == plain(whole)


def test_the_next_source_only_where_the_first_holds_nothing(spark):
    schema = "sample_id string, candidate_id string, response string"
    full, blank, other = (spark.createDataFrame(x, schema) for x in ([("1", "a", "x")], [("1", "a", None), ("2", None, "y")], [("3", "b", "z")]))
    got = lambda *s: sorted(r.candidate_id for r in C.response_index(*s).collect())
    assert got(full, other) == ["a"] and got(blank, other) == ["b"] and got(blank, blank, other) == ["b"] and got(full, blank, other) == ["a"] and got(blank) == []
    # A blank response counts as held: the index is there, and only its text is not valid.
    empty = spark.createDataFrame([("1", "a", " ")], schema)
    assert got(empty, other) == ["a"] and C.with_valid_text(full.select("sample_id", "candidate_id"), C.response_index(empty, other)).count() == 0


def test_stream_reads_the_target_once(spark, tmp_path):
    """Batches of one file: rows of the target are known from the first batch on, and no batch reads what earlier ones wrote."""
    schema = "sample_id string, candidate_id string, x long"
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    write = lambda name, *keys: (source / name).write_text("".join(json.dumps({"sample_id": s, "candidate_id": c, "x": 1}) + "\n" for s, c in keys))
    (target / "batch=old").mkdir(parents=True)
    (target / "batch=old" / "a.json").write_text(json.dumps({"sample_id": "0", "candidate_id": "old", "x": 0}) + "\n")
    seen = []

    def judge(batch):
        rows = batch.collect()
        seen.append(sorted((r.sample_id, r.candidate_id) for r in rows))
        return spark.createDataFrame(rows, schema)

    run = lambda: judge_stream(spark, str(source), schema, judge, str(target), schema, str(tmp_path / "c"), files_per_batch=1).awaitTermination()
    write("a.json", ("0", "old"), ("1", "a"), ("1", "a"))
    run()
    # Whatever the target says now does not matter: the state knows what is done.
    for f in target.rglob("*.json"):
        f.unlink()
    write("b.json", ("1", "a"), ("0", "old"), ("2", "b"))
    run()
    assert [s for s in seen if s] == [[("1", "a")], [("2", "b")]]

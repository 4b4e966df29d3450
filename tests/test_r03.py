"""What a third review found: bounds of bins, batches of streams, and rows held by a parser."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon import queries
from quillon.fixtures import Tables
from quillon.functions.model_json import reply_parser, without_fence
from quillon.operators import stats as T
from quillon.plans import clients, models, stages
from quillon.sources import shared
from quillon.streaming.incremental import judge_stream


def test_histogram_divides_before_it_multiplies(spark):
    """150.03 of 500.1 is share 0.3 exactly, and opens the bin that 20 * 150.03 / 500.1 is just below."""
    values = [0.0, 150.03, 300.06, 350.07, 450.09, 500.1]
    got = T.histogram(spark.createDataFrame([(x,) for x in values], "x double"), "x").collect()
    assert sorted((r.bin, r.n) for r in got) == [(1, 1), (7, 1), (13, 1), (15, 1), (19, 1), (20, 1)]
    assert T.histogram(spark.createDataFrame([(4.0,), (4.0,), (None,)], "x double"), "x").collect() == [(11, 2)]


def test_batches_of_a_stream_grow_with_its_files(spark, tmp_path):
    """200 files: 2 a batch made 100 batches, whose costs of their own exceed those of the rows; now there are MOST_BATCHES at most."""
    rows = spark.range(400).select(F.lit("m").alias("model"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt")).repartition(4)
    told = []
    known = {"m": clients.Service(lambda settings: models.StubClient(), {}, "e")}
    got = models.ask(rows, "prompt", "model", known, batch_rows=2, batch_files=2, progress=told.append)
    assert got.filter("reply is not null").count() == 400 == sum(p["models"]["m"]["done"] for p in told)
    assert len(told) <= shared.MOST_BATCHES
    assert shared.files_a_batch(spark, f"{tmp_path}/none", "parquet", 3) == 3


def test_incremental_batches_grow_with_the_files(spark, tmp_path):
    source, schema = tmp_path / "in", "sample_id string, candidate_id string"
    source.mkdir()
    for i in range(80):
        (source / f"{i}.json").write_text(json.dumps({"sample_id": str(i), "candidate_id": "c"}) + "\n")
    query = judge_stream(spark, str(source), schema, lambda df: df, str(tmp_path / "out"), schema, str(tmp_path / "c"), files_per_batch=1)
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) <= shared.MOST_BATCHES
    assert spark.read.schema(schema).json(str(tmp_path / "out")).distinct().count() == 80


def test_a_parser_holds_some_replies_of_a_batch():
    """Ten replies of 1 MB come back in ten pieces, and in order."""
    text = json.dumps({"checks": [{"rule_id": "a", "hit": True, "reason": "x" * (1 << 20)}], "confidence": True})
    parse = reply_parser(without_fence).func
    out = list(parse(iter([pa.array([text, None] * 10)])))
    assert len(out) >= 10 and sum(map(len, out)) == 20
    assert [x is not None for part in out for x in part.field("checks").to_pylist()] == [True, False] * 10
    assert {x for part in out for x in part.field("confidence").to_pylist()} == {"1.0", None}


def test_a_batch_of_prompts_is_asked_in_slices():
    known = {"": clients.Service(lambda settings: models.StubClient(), {}, "")}
    run = models._caller(known, 1, 0.0, 0.0, None)
    batch = pa.RecordBatch.from_pydict({"ask_key": [str(i) for i in range(20)], "model": ["m"] * 20, "prompt": [str(i) + "x" * (1 << 20) for i in range(20)]})
    out = list(run(iter([batch])))
    assert len(out) >= 10 and [k for b in out for k in b.column("ask_key").to_pylist()] == batch.column("ask_key").to_pylist()
    assert all(r for b in out for r in b.column("reply").to_pylist())


def test_repeat_merge_numbers_the_runs_once(spark):
    """One window over the runs and one merge: before, each of three sets numbered all runs."""
    sorts = []
    whole = Tables.repeats
    try:
        Tables.repeats = lambda t: sorts.append(1) or whole(t)
        own = queries.QUERIES["repeat_merge"](spark, "/root/testdata/sf0.001")
    finally:
        Tables.repeats = whole
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert len(sorts) == 1 and plan.count("Aggregate") == 1 and "Window" not in plan
    want = queries.QUERIES["repeat_aggregate"](spark, "/root/testdata/sf0.001")
    assert sorted(own.collect()) == sorted(want.select(own.columns).collect())


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan()


def test_threads_take_prompts_without_a_future_for_each(monkeypatch):
    """1,000 quick calls: 1,000 futures before, one a thread and slice now; replies stay with their prompts, and a broken client still breaks the task."""
    submitted = []
    submit = models.ThreadPoolExecutor.submit
    monkeypatch.setattr(models.ThreadPoolExecutor, "submit", lambda *a: submitted.append(1) or submit(*a))

    class Echo:
        def complete(self, model_name, prompt):
            if prompt == "p7":
                raise OSError("seven")
            if prompt == "exit":
                raise SystemExit
            return f"{model_name} {prompt}"

    def asked(*prompts):
        known = {"": clients.Service(lambda settings: Echo(), {}, "", threads=8)}
        batch = pa.RecordBatch.from_pydict({"ask_key": list(prompts), "model": ["m"] * len(prompts), "prompt": list(prompts)}, schema=pa.schema([(c, pa.string()) for c in ("ask_key", "model", "prompt")]))
        return [r for b in models._caller(known, 2, 0.0, 0.0, None)(iter([batch])) for r in b.to_pylist()]

    got = asked(*[f"p{i}" for i in range(1000)])
    assert len(submitted) <= 8
    assert [r["ask_key"] for r in got] == [f"p{i}" for i in range(1000)]
    assert all((r["reply"], r["tries"]) == ((None, 2) if i == 7 else (f"m p{i}", 1)) for i, r in enumerate(got)) and got[7]["error"] == "OSError: seven"
    assert asked() == [] and asked("p1")[0]["reply"] == "m p1"
    with pytest.raises(SystemExit):
        asked("p1", "exit")


def test_replies_are_joined_without_the_prompts(spark):
    """The prompts went through the shuffle of the join, only to tell which of them are null."""
    rows = spark.range(4).select("id", F.lit("m").alias("model"), F.when(F.col("id") > 0, F.concat(F.lit("p"), F.col("id").cast("string"))).alias("prompt"))
    got = models.ask(rows, "prompt", "model", {"m": clients.Service(lambda settings: models.StubClient(), {}, "e")}).drop("prompt")
    (join,) = [p for p in _nodes(_optimized(got)) if p.nodeName() == "Join"]
    assert "prompt" not in join.left().output().toString()
    assert sorted((r.id, r.reply is None, r.reply_error) for r in got.collect()) == [(0, True, "no prompt"), *((i, False, None) for i in (1, 2, 3))]
    other = models.ask(rows.withColumn("model", F.lit("x")), "prompt", "model", {"m": clients.Service(lambda settings: models.StubClient(), {}, "e")})
    assert {(r.id > 0, r.reply_error) for r in other.collect()} == {(False, "no prompt"), (True, "no client serves this model")}


def test_a_reply_is_parsed_once_and_a_sample_once(spark, monkeypatch):
    """Each side's parser stands once in the plan (twice before, as a filter on it was pushed below the join), no window numbers the
    candidates of a sample, and what prompts tell of a sample and its data is worked out before the join with the candidates."""
    asked = []
    monkeypatch.setattr(stages, "ask_both", lambda rows, *a, whole=stages.ask_both, **k: asked.append(rows) or whole(rows, *a, **k))
    judged = queries.QUERIES["judge_deductions"](spark, "/root/testdata/sf0.001")
    plan = _optimized(judged).toString()
    assert plan.count("parse(ground_raw") == plan.count("parse(structure_raw") == 1
    before = [p for p in _nodes(_optimized(asked[0]))]
    assert not any(p.nodeName() == "Window" and "sample_id" in p.toString().splitlines()[0] for p in before)
    joins = [p for p in before if p.nodeName() == "Join" and "sample_id" in str(p.condition())]
    assert joins and all("_told" in p.right().output().toString() and "last_answer_phone" not in p.right().output().toString() for p in joins)


def test_findings_of_a_rule_are_worked_out_once(spark):
    rows = [([("a", "5", "r1", "x"), ("B", "20", "r2", "x"), ("A", "9", "r3", "x"), ("a", "9", "r4", "x"), ("c", "none", "r5", "x")],), ([],), (None,)]
    df = spark.createDataFrame(rows, "p array<struct<rule_id: string, score: string, reason: string, excerpt: string>>")
    got = df.select(stages.dedup_penalties(F.col("p")).alias("p"))
    assert _optimized(got).toString().count("upper(") == 1
    assert [r.p and [(p.rule_id, p.score, p.reason) for p in r.p] for r in got.collect()] == [[("A", 10.0, "r3"), ("B", 20.0, "r2")], [], None]

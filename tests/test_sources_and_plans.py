import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quillon.operators import candidates as C
from quillon.operators import repeats as A
from quillon.plans import config, models, stages
from quillon.sources import readers, writers
from quillon.streaming.incremental import judge_stream

CSV = '''sample_id,query,一级分类,last_query,data,service,last_answer_phone,a_answer,b_answer,winner
1,"line one
line two ""quoted""",L1,,"{""sleep"": {""duration_hours"": 7}}",  ,prior,A1,,a
2,second,,hist,,svc,,,B2,b
3,third,,,,,,,,
'''


@pytest.fixture
def samples(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV, encoding="utf-8")
    return readers.scan_samples(spark, str(path))


MODELS = (config.Model("gen", "m1"), config.Model("gen", "m2", "closed_source"), config.Model("ref", "a_answer", "reference", {"answer_key": "a_answer"}))


def test_csv(spark, samples, tmp_path):
    rows = samples.orderBy("_ordinal").collect()
    assert rows[0].query == 'line one\nline two "quoted"' and rows[0].category_level1 == "L1" and rows[0].winner == "a"
    assert [r.reference_answers for r in rows] == [{"a_answer": "A1"}, {"b_answer": "B2"}, None]
    assert readers.scan_samples(spark, str(tmp_path / "raw.csv"), 2).count() == 2 and readers.scan_samples(spark, str(tmp_path / "raw.csv"), -1).count() == 0
    assert readers.check_unique_ids(samples) is samples
    with pytest.raises(ValueError):
        readers.check_unique_ids(samples.unionByName(samples))
    with pytest.raises(ValueError):
        readers.samples_from(samples.drop("query"), F.col("_ordinal"))
    two = readers.scan_two_answers(spark, str(tmp_path / "raw.csv"))
    assert {"query", "answer_a", "answer_b", "_source_row_index"} <= set(two.columns) and two.count() == 3
    with pytest.raises(ValueError):
        readers.scan_two_answers(spark, "x.xlsx")


def test_json_lines_with_bad_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"sample_id": "1"}\n\nnot json\n{"sample_id": "2"}\n')
    assert readers.read_jsonl(spark, str(path), "sample_id string", "skip").count() == 2
    kept = readers.read_jsonl(spark, str(path), "sample_id string", "keep").cache()
    assert [r._raw for r in kept.filter("_raw is not null").collect()] == ["not json"]
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(path), "sample_id string").collect()
    assert readers.read_jsonl(spark, str(tmp_path / "none.jsonl"), "sample_id string").count() == 0
    (tmp_path / "list.json").write_text('[{"sample_id": "7"}, {"sample_id": "8"}]')
    assert readers.read_json_document(spark, str(tmp_path / "list.json"), "sample_id string").count() == 2
    assert readers.read_results(spark, str(tmp_path), "sample_id string").filter("sample_id = '1'").count() == 1


def test_paths():
    assert writers.repeat_path("out/judge.jsonl", 2) == "out/judge_repeats/judge_repeat2.jsonl"
    assert writers.manual_path("a/b.jsonl") == "a/b_rank_manually.jsonl"


def test_config(spark):
    good = {"generators": [{"name": "g", "model_name": "m"}], "judges": [{"name": "j"}], "ranking": {"top_k": 2}}
    got = config.parse_config(json.dumps(good), "data/raw.csv")
    assert got.ranking.top_k == 2 and got.ranking.min_score_diff == 0.0 and got.file("pairs.jsonl") == "data/raw/pairs.jsonl"
    for bad in ({}, {"generators": [{"model_name": "m"}]}, good | {"generators": good["generators"] * 2}, good | {"ranking": {"top_k": 0}}, good | {"generators": [{"name": "x", "model_type": "?"}]}):
        with pytest.raises(ValueError):
            config.parse_config(json.dumps(bad), "raw.csv")
    assert config.base_url("https://h/v1/chat/completions") == config.base_url("https://h/v1/") == config.base_url("https://h") == "https://h/v1"


def test_retries():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("x")
        return "ok"

    assert models.with_retries(flaky, 5, 0, 0) == ("ok", None)
    assert models.with_retries(lambda: 1 / 0, 2, 0, 0)[1].startswith("ZeroDivisionError")


def test_run_from_samples_to_pairs(spark, samples):
    table = config.model_table(spark, MODELS)
    made = stages.generate(samples, table, models.StubClient).cache()
    assert made.count() == 9
    picks = {r.sample_id: r.response for r in made.filter("model_type = 'reference'").collect()}
    assert picks == {"1": "A1", "2": "B2", "3": "（无）"}
    v1 = stages.judge_mean(made, samples, "j", models.StubClient).collect()
    assert len(v1) == 9 and all(0 <= r.aggregate_score <= 5 and r.notes is None for r in v1)
    scored = stages.judge_deductions(made, samples, "j", models.StubClient).cache()
    assert scored.count() == 9
    for r in scored.collect():
        assert 0 <= r.total_score_20 <= 20 and 0.1 <= r.weight <= 5 and r.label == int(r.total_score_20 >= 12)
        assert r.total_score_20 == max(0, 20 - sum(p.score for p in r.penalties)) and len({p.rule_id for p in r.penalties}) == len(r.penalties)
    pairs = stages.build_pairs(scored)
    assert pairs.count() == 3
    runs = A.read_repeats([scored.drop("repeat_idx", "penalties_json_20"), scored.drop("repeat_idx", "penalties_json_20")])
    agg = A.repeat_aggregate(runs).collect()
    assert len(agg) == 9 and all(r.n_repeats == 2 and len(r.total_score_20_list) == 2 for r in agg)
    for r in agg:
        assert [c.repeat_idx for c in r.ground_output.checks] == [1] * 4 + [2] * 4 and r.ground_output.confidence == ["high", "high"]


def test_repeats_without_values(spark):
    """Runs that lack a value are skipped; where all lack it, lists are empty, and outputs stay null."""
    schema = "sample_id string, candidate_id string, candidate string, repeat_idx int, ground_score double, notes string, penalties array<struct<rule_id: string, score: double>>, ground_output struct<checks: array<struct<rule_id: string>>, confidence: string>, structure_output struct<checks: array<struct<rule_id: string>>, confidence: string>"
    rows = [("s", None, "text", 1, None, None, None, None, None), ("s", None, "text", 0, 2.0, "n", [("A", 5.0)], ([("A",)], None), None), ("s", None, "text", 2, 1.0, "m", [], (None, "0.5"), None)]
    (got,) = A.repeat_aggregate(spark.createDataFrame(rows, schema)).collect()
    assert (got.candidate_id, got.candidate, got.n_repeats) == ("text", "text", 3)
    assert got.ground_score == [2.0, 1.0] and got.ground_min_score == 1.0 and got.notes == "1: n\n3: m"
    assert [tuple(p) for p in got.penalties] == [("A", 5.0, 1)]
    assert [tuple(c) for c in got.ground_output.checks] == [("A", 1)] and got.ground_output.confidence == ["0.5"] and got.structure_output is None
    assert A.repeat_aggregate(spark.createDataFrame([], schema)).count() == 0


def test_failures(spark, samples):
    table = config.model_table(spark, MODELS[:2])

    class Broken:
        def complete(self, model_name, prompt):
            raise ConnectionError

    how = dict(tries=1, first_delay=0.0)
    made = stages.generate(samples, table, Broken, **how)
    assert made.filter("response <> '[no answer was generated]'").count() == 0
    v1 = stages.judge_mean(made, samples, "j", Broken, **how).collect()
    assert all(r.aggregate_score == 0 and r.notes.startswith("ConnectionError") for r in v1) and len(v1) == 6
    assert stages.judge_deductions(made, samples, "j", Broken, how=how).count() == 0
    repaired = stages.repair(samples, table, made, models.StubClient)
    assert repaired.count() == 3 and all(len(r.candidates) == 2 and not any("no answer" in c.response for c in r.candidates) for r in repaired.collect())
    again = stages.repair(samples, table, made, Broken, **how).collect()
    assert all("no answer" in c.response for r in again for c in r.candidates) and len(again) == 3


def test_patch_takes_worthless_samples(spark, samples, tmp_path):
    judged = spark.createDataFrame([("1", [("c", "m", "t", 0.0, 0.0, 0.0, 0.0)]), ("2", [("c", "m", "t", 5.0, 5.0, 5.0, 20.0), ("d", "m", "t", 0.0, 0.0, 0.0, None)])], "sample_id string, results array<struct<candidate_id: string, model_name: string, model_type: string, aggregate_score: double, ground_score: double, structure_score: double, total_score_20: double>>")
    assert [r.sample_id for r in stages.patch(samples, judged, "f").collect()] == ["1"]


def test_group_and_flatten_are_inverse(spark):
    rows = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("t", 5, "c")], "sample_id string, _pos int, candidate_id string")
    flat = C.flatten_grouped(C.group_by_sample(rows)).orderBy("sample_id", "_pos").collect()
    assert [(r.sample_id, r._pos, r.candidate_id) for r in flat] == [("s", 0, "a"), ("s", 1, "b"), ("t", 0, "c")]


def test_stream_judges_once(spark, samples, tmp_path):
    schema = "sample_id string, candidate_id string, model_type string, model_name string, response string, _pos long"
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    line = lambda s, c: json.dumps({"sample_id": s, "candidate_id": c, "model_type": "t", "model_name": "m", "response": "- x", "_pos": 1}) + "\n"
    (source / "a.jsonl").write_text(line("1", "c1") + line("2", "c2") + line("2", "c2"))
    judge = lambda df: stages.judge_deductions(df, samples, "j", models.StubClient).drop("penalties")
    out_schema = "sample_id string, candidate_id string, total_score_20 double"

    def run(name):
        judge_stream(spark, str(source), schema, judge, target, out_schema, str(tmp_path / name)).awaitTermination()
        return sorted((r.sample_id, r.candidate_id) for r in readers.read_jsonl(spark, target, out_schema).collect())

    assert run("c") == [("1", "c1"), ("2", "c2")]
    (source / "b.jsonl").write_text(line("3", "c3") + line("1", "c1"))
    assert run("c") == run("new checkpoint") == [("1", "c1"), ("2", "c2"), ("3", "c3")]


class Counting(models.StubClient):
    """Writes a line a call to a file, and gives no JSON where the prompt is met for the first time."""

    def __init__(self, path, spoil=False):
        super().__init__()
        self.path, self.spoil = path, spoil

    def complete(self, model_name, prompt):
        key = hashlib.sha1(f"{model_name} {prompt}".encode()).hexdigest()
        known = self.path.exists() and key in self.path.read_text().splitlines()
        with self.path.open("a") as f:
            f.write(f"{key}\n")
        return "no object" if self.spoil and not known else super().complete(model_name, prompt)


def test_replies_are_asked_for_once(spark, samples, tmp_path):
    path, store = tmp_path / "calls", f"file://{tmp_path}/replies"
    rows = samples.select("sample_id", F.lit("m").alias("model"), F.concat(F.lit("JSON "), "sample_id").alias("prompt"))
    rows = rows.unionByName(rows).unionByName(rows.limit(1).withColumn("prompt", F.lit(None).cast("string")))
    calls = lambda: len(path.read_text().splitlines())
    got = models.ask(rows, "prompt", "model", lambda: Counting(path), store=store)
    assert got.columns == [*rows.columns, "reply", "reply_error"] and got.count() == 7 and got.filter("reply is null and reply_error = 'no prompt'").count() == 1
    assert got.filter("reply is not null and reply_error is null").count() == 6 and calls() == 3
    again = models.ask(rows, "prompt", "model", lambda: Counting(path), store=store)
    assert again.count() == 7 and calls() == 3
    assert models.ask(rows, "prompt", "model", lambda: Counting(path), store=store, run=1).count() == 7 and calls() == 6


def test_replies_that_do_not_parse_are_asked_for_again(spark, samples, tmp_path):
    made = stages.generate(samples, config.model_table(spark, MODELS), models.StubClient)
    judged = stages.judge_deductions(made, samples, "j", lambda: Counting(tmp_path / "a", spoil=True), how={"first_delay": 0})
    assert judged.count() == made.count()
    once = stages.judge_deductions(made, samples, "j", lambda: Counting(tmp_path / "b", spoil=True), how={"first_delay": 0, "tries": 1})
    assert once.count() == 0


def test_two_answers_stay_or_go_together(spark, tmp_path):
    path = tmp_path / "two.csv"
    path.write_text("query,answer_a,answer_b,winner\nq1,one,two,a\nq2,,x,\nq3,y,bad,b\n", encoding="utf-8")

    class Picky(models.StubClient):
        def complete(self, model_name, prompt):
            return "no object" if "bad" in prompt.rpartition("Answer:")[2] else super().complete(model_name, prompt)

    got = stages.judge_two_answers(readers.scan_two_answers(spark, str(path)), "j", Picky, how={"first_delay": 0}).orderBy("sample_id").collect()
    assert [(r.sample_id, r.query) for r in got] == [("0", "q1"), ("1", "q2")] and all(r.total_score_20_a is not None and r.total_score_20_b is not None for r in got)


def test_commands(spark, tmp_path):
    from quillon.__main__ import run

    (tmp_path / "raw.csv").write_text(CSV, encoding="utf-8")
    (tmp_path / "run.json").write_text(json.dumps({"generators": [{"name": "m1"}, {"name": "m2"}], "judges": [{"name": "j"}], "output_dir": f"{tmp_path}/out"}))
    made = {x: run(spark, x, str(tmp_path / "raw.csv"), str(tmp_path / "run.json")) for x in ("generate", "judge", "pairs", "patch", "repair", "two-answers")}
    assert spark.read.parquet(made["generate"]).count() == 6 and spark.read.parquet(made["judge"]).count() == 6
    assert spark.read.parquet(made["pairs"]).count() == 3 and spark.read.parquet(made["repair"]).count() == 3
    assert "sample_id" in spark.read.csv(made["patch"], header=True).columns or not spark.read.csv(made["patch"], header=True).columns
    with pytest.raises(ValueError):
        run(spark, "generate", str(tmp_path / "raw.csv"), str(tmp_path / "run.json"), "unknown")
    made = {x: run(spark, x, str(tmp_path / "raw.csv"), str(tmp_path / "run.json"), repeats=2) for x in ("judge", "pairs", "patch")}
    judged = spark.read.parquet(made["judge"])
    assert [(r.n_repeats, r.judge) for r in judged.collect()] == [(2, "j")] * 6 and spark.read.parquet(made["pairs"]).count() == 3


def test_rows_of_several_files_are_numbered_in_order(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text("query\n" + "".join(f'"q{i}\n{k}"\n' for k in range(3)), encoding="utf-8")
    got = readers.scan_samples(spark, str(tmp_path)).orderBy("_ordinal").collect()
    assert [r.query for r in got] == [f"q{i}\n{k}" for i in range(3) for k in range(3)] and [r.sample_id for r in got] == [str(k + 1) for k in range(9)]
    assert readers.scan_samples(spark, str(tmp_path), 5).count() == 5
    for i in range(2):
        (tmp_path / "two").mkdir(exist_ok=True)
        (tmp_path / "two" / f"part{i}.csv").write_text("query,a_answer,b_answer\n" + f"q{i},a,b\n" * 2, encoding="utf-8")
    two = readers.scan_two_answers(spark, str(tmp_path / "two")).orderBy("_source_row_index").collect()
    assert [(r._source_row_index, r.query) for r in two] == [(0, "q0"), (1, "q0"), (2, "q1"), (3, "q1")]


def test_writers(spark, samples, tmp_path):
    writers.append_csv(samples.select("sample_id", "query"), str(tmp_path / "c"))
    writers.append_csv(samples.select("sample_id", "query"), str(tmp_path / "c"))
    assert readers.read_csv(spark, str(tmp_path / "c")).count() == 6
    writers.write_patch(samples.select("query", "sample_id", "_ordinal"), samples.filter("sample_id = '1'"), str(tmp_path / "p"))
    back = readers.read_csv(spark, str(tmp_path / "p"))
    assert back.columns == ["sample_id", "query"] and [r.sample_id for r in back.collect()] == ["1"]
    writers.write_stats(samples.groupBy("query").count(), str(tmp_path / "s"))
    assert spark.read.json(f"{tmp_path}/s/stats.jsonl").count() == 3 and readers.read_csv(spark, f"{tmp_path}/s/stats.csv").count() == 3
    old = spark.createDataFrame([("1", "f", 1), ("2", "f", 2)], "sample_id string, source_file string, x int")
    writers.write_manual(old, spark.createDataFrame([("2", "f", 3)], old.schema), str(tmp_path / "m"))
    assert sorted((r.sample_id, r.x) for r in spark.read.json(str(tmp_path / "m")).collect()) == [("1", 1), ("2", 3)]
    settings = config.read_config(spark, _written(tmp_path / "c.json", json.dumps({"generators": [{"name": "m"}]})), "a/b.csv")
    assert settings.generators[0].name == "m" and settings.folder == "a/b"


def _written(path, text):
    path.write_text(text)
    return str(path)


def test_bad_lines_keep_their_number(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x":\n{"x": 2}\n', encoding="utf-8")
    (tmp_path / "b.jsonl").write_text("no\n" + '{"x": 3}\n' * 4000, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = readers.read_jsonl_lines(spark, str(tmp_path), "x int").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    of = lambda name: sorted((r["_line_no"], r["x"], r["_raw"]) for r in rows if r["_file"].endswith(name))
    assert of("a.jsonl") == [(1, 1, None), (3, None, '{"x":'), (4, 2, None)]
    assert of("b.jsonl")[0] == (1, None, "no") and of("b.jsonl")[1:] == [(i, 3, None) for i in range(2, 4002)]


def test_stage_files(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "judge_results.jsonl").write_text('{"x": 1}\n')
    for name in ("empty.jsonl", "none.jsonl"):
        with pytest.raises(ValueError):
            readers.read_stage(spark, str(tmp_path / name), "x int")
    assert readers.read_stage(spark, str(tmp_path / "judge_results.jsonl"), "x int").count() == 1
    files = readers.result_files(spark, str(tmp_path))
    assert [f.rpartition("/")[2] for f in files] == ["empty.jsonl", "judge_results.jsonl"] and readers.default_file(files) == files[1]
    assert readers.default_file([*files, "judge_results_kto.jsonl"]) == "judge_results_kto.jsonl" and readers.default_file([]) is None


def test_merged_human_ranks_keep_bad_lines(spark, tmp_path):
    schema = "sample_id string, source_file string, x int"
    (tmp_path / "m.jsonl").write_text('{"sample_id": "1", "source_file": "f", "x": 1}\n{broken\n{"sample_id": "2", "source_file": "f"}\n')
    new = spark.createDataFrame([("2", "f", 3)], schema)
    writers.merge_manual(readers.read_jsonl_lines(spark, str(tmp_path / "m.jsonl"), schema), new, str(tmp_path / "out"))
    back = readers.read_jsonl(spark, str(tmp_path / "out"), schema, "keep").collect()
    assert sorted(repr((r.sample_id, r.x, r["_raw"])) for r in back) == sorted(map(repr, [("1", 1, None), ("2", 3, None), (None, None, "{broken")]))


def test_score_that_is_no_number_drops_the_candidate(spark, samples):
    made = stages.generate(samples, config.model_table(spark, MODELS), models.StubClient)
    graded = lambda score: samples.withColumn("data", F.lit('{"sleep": {"score": "%s", "score_thresholds": {"poor": [0, 40]}}}' % score))
    assert stages.judge_deductions(made, graded("n/a"), "j", models.StubClient).count() == 0
    assert stages.judge_deductions(made, graded("30"), "j", models.StubClient).count() == made.count()

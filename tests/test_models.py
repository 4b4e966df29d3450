"""Calls of models: batches that are committed, runs that are killed, services by configuration, load of endpoints, progress."""

import hashlib
import http.server
import json
import os
import signal
import subprocess
import sys
import threading
import time

import pytest
from pyspark.sql import functions as F

from quillon.plans import clients, config, models, stages
from quillon.plans.config import Model
from quillon.sources import readers


class Noting(models.StubClient):
    """Appends when each call began and ended to a file of its model; fails where told, as often as told."""

    def __init__(self, settings):
        super().__init__(settings={k: v for k, v in settings.items() if k not in ("log", "wait", "breaks", "endpoint")} or None)
        self.log, self.wait, self.breaks = settings["log"], settings.get("wait", 0), settings.get("breaks")

    def complete(self, model_name, prompt):
        began = time.time()
        time.sleep(self.wait)
        with open(f"{self.log}/{model_name}", "a") as f:
            f.write(json.dumps([began, time.time(), prompt]) + "\n")
        if self.breaks and os.path.exists(self.breaks):
            os.kill(os.getpid(), signal.SIGKILL)
        return super().complete(model_name, prompt)


def calls(folder, model):
    path = folder / model
    return [json.loads(x) for x in path.read_text().splitlines()] if path.exists() else []


def most_at_once(spans):
    marks = sorted([(a, 1) for a, *_ in spans] + [(b, -1) for _, b, *_ in spans])
    at = most = 0
    for _, d in marks:
        at += d
        most = max(most, at)
    return most


def prompts(spark, n, *names):
    return spark.range(n).select(F.concat(F.lit("JSON "), "id").alias("prompt"), F.explode(F.array(*[F.lit(x) for x in names])).alias("model"))


def test_services():
    made = clients.services([Model("a", "m1", settings={"temperature": 0}), Model("b", "m2", settings={"client": "chat", "endpoint": "http://x", "partitions": 3, "threads": 2})])
    assert made["m1"].endpoint == "stub" and made["m1"].settings == {"temperature": 0}
    assert (made["m2"].endpoint, made["m2"].partitions, made["m2"].threads, made["m2"].settings) == ("http://x", 3, 2, {"endpoint": "http://x"})
    for bad in ([Model("a", "m", settings={"client": "unknown"})], [Model("a", "m", settings={"client": "no_module:x"})], [Model("a", "m", settings={"threads": 0})], [Model("a", "m"), Model("b", "m", settings={"t": 1})], [Model("a", "m"), Model("b", "n", settings={"threads": 1})]):
        with pytest.raises(ValueError):
            clients.services(bad)


def test_gate_halves_and_recovers():
    gate = clients.Gate(8)
    with pytest.raises(ZeroDivisionError):
        gate(lambda: 1 / 0)
    assert gate.limit == 4
    for _ in range(4):
        gate(lambda: "ok")
    assert 4.8 < gate.limit < 5.1
    for _ in range(40):
        gate(lambda: "ok")
    assert gate.limit == 8 and gate.running == 0
    for _ in range(9):
        with pytest.raises(ZeroDivisionError):
            gate(lambda: 1 / 0)
    assert gate.limit == 1 and gate(lambda: "ok") == "ok"


def test_settings_reach_the_client(spark):
    rows = prompts(spark, 5, "m1", "m2", "m3")
    known = clients.services([Model("a", "m1", settings={"temperature": 0}), Model("b", "m2", settings={"temperature": 1})])
    got = models.ask(rows, "prompt", "model", known).collect()
    stub = {m: models.StubClient(settings={"temperature": t}) for m, t in (("m1", 0), ("m2", 1))}
    assert len(got) == 15 and all(r.reply == stub[r.model].complete(r.model, r.prompt) for r in got if r.model != "m3")
    assert {(r.reply, r.reply_error) for r in got if r.model == "m3"} == {(None, "no client serves this model")}
    assert models.StubClient().complete("m", "p") != models.StubClient(settings={"t": 1}).complete("m", "p")


def test_calls_in_flight_at_each_endpoint(spark, tmp_path):
    """Two models share an endpoint of two tasks of two calls; a third has one call at a time."""
    (tmp_path / "log").mkdir()
    settings = lambda endpoint, p, t: {"client": "tests.test_models:Noting", "endpoint": endpoint, "partitions": p, "threads": t, "log": str(tmp_path / "log"), "wait": 0.05}
    known = clients.services([Model("a", "m1", settings=settings("x", 2, 2)), Model("b", "m2", settings=settings("x", 2, 2)), Model("c", "m3", settings=settings("y", 1, 1))])
    got = models.ask(prompts(spark, 24, "m1", "m2", "m3"), "prompt", "model", known, batch_rows=20, batch_files=2)
    assert got.filter("reply is not null").count() == 72
    shared = calls(tmp_path / "log", "m1") + calls(tmp_path / "log", "m2")
    assert len(shared) == 48 and 2 <= most_at_once(shared) <= 4
    assert len(calls(tmp_path / "log", "m3")) == 24 and most_at_once(calls(tmp_path / "log", "m3")) == 1


KILLED = """
import sys
from pyspark.sql import SparkSession
from quillon.plans import clients, models
from quillon.plans.config import Model
from tests.test_models import prompts
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
log, store = sys.argv[1:]
known = clients.services([Model("a", "m", settings={"client": "tests.test_models:Noting", "log": log, "wait": 0.02})])
seen = []
def told(p):
    seen.append(p)
    print(p, flush=True)
    if len(seen) == 2:
        import os, signal
        os.kill(os.getpid(), signal.SIGKILL)
models.ask(prompts(spark, 40, "m"), "prompt", "model", known, store=store, batch_rows=4, batch_files=1, progress=told)
"""


def test_a_killed_run_goes_on(spark, tmp_path):
    """The driver is killed after some batches; the next run asks for nothing whose batch was committed."""
    log, store = tmp_path / "log", f"file://{tmp_path}/store"
    log.mkdir()
    place = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", KILLED, str(log), store], cwd=place, env=os.environ | {"PYTHONPATH": f"{place}:{os.environ.get('PYTHONPATH', '')}"}, capture_output=True, timeout=240)
    assert got.returncode != 0
    time.sleep(3)  # the killed driver's JVM ends by itself
    kept = {r.ask_key for r in models.stored_replies(spark, store).collect()}
    before = [p for *_, p in calls(log, "m")]
    assert 8 <= len(kept) < 40 and len(before) == len(set(before))
    known = clients.services([Model("a", "m", settings={"client": "tests.test_models:Noting", "log": str(log), "wait": 0.02})])
    rows = models.ask(prompts(spark, 40, "m"), "prompt", "model", known, store=store, batch_rows=4, batch_files=1)
    assert rows.filter("reply is not null and reply_error is null").count() == 40
    after = [p for *_, p in calls(log, "m")][len(before) :]
    settings = json.dumps({"log": str(log), "wait": 0.02}, sort_keys=True)
    key = lambda p: hashlib.sha256("\n".join(["0", "m", settings, p]).encode()).hexdigest()
    # Prompts of committed batches are never asked for again; at most one batch was asked for in vain.
    assert not {key(p) for p in after} & kept and len(after) == len(set(after)) == 40 - len(kept)
    assert models.ask(prompts(spark, 40, "m"), "prompt", "model", known, store=store).count() == 40
    assert len(calls(log, "m")) == len(before) + len(after)


def test_progress_equals_the_table(spark):
    told = []
    known = {m: clients.Service(lambda settings, m=m: models.StubClient(fails=3 if m == "m1" else 0), {}, "e") for m in ("m1", "m2")}
    got = models.ask(prompts(spark, 30, "m1", "m2"), "prompt", "model", known, tries=2, first_delay=0, batch_rows=7, batch_files=1, progress=told.append)
    failed = {r.model: r.n for r in got.groupBy("model").agg(F.count("reply_error").alias("n")).collect()}
    total = lambda m, c: sum(p["models"][m][c] for p in told)
    assert [p["batch"] for p in told] == list(range(len(told))) and len(told) > 5
    for m in ("m1", "m2"):
        assert (total(m, "done"), total(m, "failed"), total(m, "asked_again")) == (30, failed[m], failed[m])
    assert failed["m1"] > 0 == failed["m2"]


class Chat(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.seen.append((self.path, self.headers.get("Authorization"), body))
        text = "JSON" if "response_format" in body else f"{body['model']} at {body.get('temperature')}: {body['messages'][0]['content']}"
        data = json.dumps({"choices": [{"message": {"content": text}}]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *_):
        pass


def test_chat_client(spark, monkeypatch):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Chat)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        monkeypatch.setenv("SOME_KEY", "secret")
        endpoint = f"http://127.0.0.1:{server.server_port}"
        client = models.ChatClient({"endpoint": endpoint, "api_key_env": "SOME_KEY", "temperature": 0.5})
        assert client.complete("m", "hi") == "m at 0.5: hi" and client.complete_json("m", "hi") == "JSON"
        assert Chat.seen[0][:2] == ("/v1/chat/completions", "Bearer secret") and Chat.seen[1][2]["response_format"] == {"type": "json_object"}
        known = clients.services([Model("a", "m1", settings={"client": "chat", "endpoint": endpoint, "temperature": 1})])
        got = models.ask(prompts(spark, 3, "m1"), "prompt", "model", known)
        assert sorted(r.reply for r in got.collect()) == [f"m1 at 1: JSON {i}" for i in range(3)]
    finally:
        server.shutdown()
    for settings in ({}, {"endpoint": "http://x", "api_key_env": "NOT_SET_ANYWHERE"}):
        with pytest.raises(ValueError):
            models.ChatClient(settings)


class Bad(models.StubClient):
    """Fails for one model until a file is there."""

    def __init__(self, settings):
        super().__init__()
        self.path = settings["path"]

    def complete(self, model_name, prompt):
        if "JSON" not in prompt and model_name == "m2" and not os.path.exists(self.path):
            raise ConnectionError
        return super().complete(model_name, prompt)


def test_what_is_repaired_is_judged(spark, tmp_path):
    from quillon.__main__ import run

    (tmp_path / "raw.csv").write_text("query\nq1\nq2\n", encoding="utf-8")
    bad = {"client": "tests.test_models:Bad", "path": str(tmp_path / "works")}
    spec = {"generators": [{"name": "m1"}, {"name": "m2", **bad}], "judges": [{"name": "j"}, {"name": "k"}], "output_dir": f"{tmp_path}/out"}
    (tmp_path / "run.json").write_text(json.dumps(spec))
    do = lambda command, **how: run(spark, command, str(tmp_path / "raw.csv"), str(tmp_path / "run.json"), **how)
    mark = "[no answer was generated]"
    made = spark.read.parquet(do("generate"))
    assert sorted(r.model_name for r in made.filter(F.col("response") == mark).collect()) == ["m2", "m2"]
    (tmp_path / "works").write_text("")
    repaired = spark.read.parquet(do("repair"))
    assert all(mark not in c.response for r in repaired.collect() for c in r.candidates)
    judged = spark.read.parquet(do("judge"))
    latest = spark.read.parquet(f"{tmp_path}/out/generated/version=1")
    assert latest.count() == 4 and latest.filter(F.col("response") == mark).count() == 0 and judged.count() == 8
    # The judges were asked about the new answers.
    asked = spark.read.schema(models.TASKS).parquet(f"{tmp_path}/out/replies_judge/tasks")
    assert asked.filter(F.contains("prompt", F.lit(mark))).count() == 0
    assert all(asked.filter(F.contains("prompt", F.lit(r.response))).count() > 0 for r in latest.collect())
    mean = spark.read.parquet(do("judge-mean", repeats=2))
    assert mean.count() == 16 and {(r.judge, r.repeat_idx) for r in mean.collect()} == {(j, i) for j in "jk" for i in (0, 1)}
    stats = readers.read_csv(spark, f"{do('stats')}/stats.csv")
    assert stats.count() == 2
    ranks = tmp_path / "ranks.jsonl"
    ranks.write_text(json.dumps({"sample_id": "1", "source_file": str(tmp_path / "raw.csv"), "manual_ranks": [{"candidate_id": "c", "manual_score": 5}]}) + "\n")
    merged = {r.sample_id: r for r in spark.read.parquet(do("rank", ranks=str(ranks))).collect()}
    assert merged["1"].manual_ranks[0].manual_score == 5 and len(merged["2"].manual_ranks) == 4
    (tmp_path / "raw.csv").write_text("query,a_answer,b_answer\nq1,x,y\nq2,z,w\n", encoding="utf-8")
    two = spark.read.parquet(do("two-answers", repeats=2)).collect()
    assert sorted((r.judge, r.sample_id, r.n_repeats_a, r.n_repeats_b) for r in two) == [(j, i, 2, 2) for j in "jk" for i in "01"]
    spec["judges"] = []
    (tmp_path / "run.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="no judges"):
        do("judge")


def test_generate_takes_services(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("query\nq1\nq2\n", encoding="utf-8")
    own = [Model("a", "m1", settings={"temperature": 0}), Model("b", "m2", "experimental", {"temperature": 1})]
    samples = readers.scan_samples(spark, str(tmp_path / "raw.csv"))
    made = stages.generate(samples, config.model_table(spark, tuple(own)), clients.services(own))
    assert made.count() == 4 and made.filter("response like '- answer %'").count() == 4

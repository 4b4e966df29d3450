"""Calls of language models as a stream: bounded batches, bounded calls for each endpoint, one reply or error a prompt.

Prompts are a table of tasks, named by the hash of run, model, its settings and prompt. A file stream takes some files of it at a
time; each batch is dealt out by endpoint, and its replies are committed under the batch's number before the next one begins. A
run that is killed loses the calls of one batch at most (which grows with the store, see MOST_BATCHES): the next run first finishes the tasks that were left, from the
stream's checkpoint. What is derived reads the table of replies, so neither a second action nor a lost executor repeats a call
whose reply is stored; with a `store` that lasts, neither does a later run: it asks only for what the table lacks.

A store takes one run at a time.
"""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.plans.clients import CLIENTS, ChatClient, Client, Gate, Service, StubClient, client_named, services
from quillon.sources.shared import files_a_batch, scratch, slices

__all__ = ["CLIENTS", "ChatClient", "Client", "Gate", "Service", "StubClient", "ask", "client_named", "services", "stored_replies", "with_retries"]

TASKS = "ask_key string, model string, prompt string"
REPLIES = "ask_key string, model string, reply string, error string, tries int"
#: What a model's counts are called in a report of progress.
COUNTS = ("done", "failed", "asked_again")


def with_retries(call: Callable[[], str], tries: int, first_delay: float, most_delay: float, accept: Callable[[str], bool] | None = None) -> tuple[str | None, str | None]:
    """(reply, None), or (the last reply or None, last error); delays double up to a bound. A reply that is not accepted is asked for again."""
    reply = error = None
    for i in range(tries):
        try:
            reply = call()
            if accept is None or accept(reply):
                return reply, None
            error = "the reply does not parse"
        except Exception as e:  # noqa: BLE001 - any failure of a client is an error of its row
            error = f"{type(e).__name__}: {e}"
        if i + 1 < tries:
            time.sleep(min(most_delay, first_delay * 2**i))
    return reply, error


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a table; none where it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored_replies(spark: SparkSession, store: str) -> DataFrame:
    """One row for each prompt that was asked: its reply without error if there is one."""
    best = F.max(F.struct(F.col("error").isNull().alias("good"), "reply", "error"))
    return _stored(spark, f"{store}/replies", REPLIES).groupBy("ask_key").agg(best.alias("best")).select("ask_key", "best.reply", "best.error", "best.good")


def _slots(known: dict[str, Service]) -> tuple[dict[str, tuple[int, int]], int]:
    """The first slot and the number of slots of each endpoint, and the number of all slots: a slot is a partition of a batch."""
    first, out = 0, {}
    for s in sorted(known.values(), key=lambda s: s.endpoint):
        if s.endpoint not in out:
            out[s.endpoint] = first, s.partitions
            first += s.partitions
    return out, first


def _by_model(known: dict[str, Service], value: Callable[[Service], object], kind: str) -> Column:
    """A value of each model's service, looked up by the column model."""
    pairs = [x for m, s in known.items() for x in (F.lit(m), F.lit(value(s)).cast(kind))]
    return F.try_element_at(F.create_map(*pairs), F.col("model"))


def _caller(known: dict[str, Service], tries: int, first_delay: float, most_delay: float, accept: Callable[[str], bool] | None):
    """A function of batches of tasks of one endpoint, to batches of replies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clients: dict[str, Client] = {}
        gate = pool = None

        def one(model: str, prompt: str) -> tuple[str | None, str | None, int]:
            count = 0
            client = clients[model]
            ways = iter([client.complete_json] if accept and hasattr(client, "complete_json") else [])

            def call() -> str:
                nonlocal count
                count += 1
                way = next(ways, client.complete)
                return gate(lambda: way(model, prompt))

            return *with_retries(call, tries, first_delay, most_delay, accept), count

        def take(places: Iterator[int], asked: list[str], prompts: list[str], found: list) -> None:
            try:
                for i in places:
                    found[i] = one(asked[i], prompts[i])
            finally:
                for _ in places:  # a thread that breaks leaves nothing for the others
                    pass

        for batch in (x for whole in batches for x in slices(whole, whole.column("prompt"))):
            asked, prompts = batch.column("model").to_pylist(), batch.column("prompt").to_pylist()
            for m in {*asked} - {*clients}:
                service = known.get(m) or known[""]
                clients[m] = service.factory(service.settings)
                gate, pool = gate or Gate(service.threads), pool or ThreadPoolExecutor(service.threads)
            # Each thread takes the next place until there is none: a future for each prompt costs more than a quick call.
            found, places = [None] * len(asked), iter(range(len(asked)))
            for done in [pool.submit(take, places, asked, prompts, found) for _ in range(min(gate.most, len(asked)) if asked else 0)]:
                done.result()
            kinds = (pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("ask_key"), batch.column("model"), *(pa.array([f[i] for f in found], k) for i, k in enumerate(kinds))], ["ask_key", "model", "reply", "error", "tries"])
        if pool:
            pool.shutdown()

    return run


def _counts(models: list[str]) -> list[Column]:
    """Counts of each model (of all, where models are not configured), as columns named by its number."""
    out = []
    for i, m in enumerate(models or [None]):
        mine = F.col("model") == m if m is not None else F.lit(True)
        one = F.when(mine, 1)
        out += [F.count(one).alias(f"done_{i}"), F.count(F.when(mine & F.col("error").isNotNull(), 1)).alias(f"failed_{i}"), F.sum(F.when(mine, F.col("tries") - 1).otherwise(0)).alias(f"asked_again_{i}")]
    return out


def drain(spark: SparkSession, store: str, known: dict[str, Service], batch_files: int, progress: Callable[[dict], None] | None = None, **how) -> None:
    """Asks for all tasks of the store that no committed batch holds, batch by batch.

    progress is told of every batch: its number and, by model, what was done, what of it failed and how often was asked again.
    """
    places, slots = _slots(known)
    models = sorted(m for m in known if m)
    tasks = spark.readStream.schema(TASKS).option("maxFilesPerTrigger", files_a_batch(spark, f"{store}/tasks", "parquet", batch_files)).option("maxFileAge", "36500d").parquet(f"{store}/tasks")
    first, n = (_by_model(known, lambda s, i=i: places[s.endpoint][i], "int") if models else F.lit(places[known[""].endpoint][i]) for i in (0, 1))
    dealt = tasks.repartitionById(slots, (first + F.pmod(F.xxhash64("ask_key"), n)).cast("int"))
    replies = dealt.mapInArrow(_caller(known, **how), REPLIES).observe("asked", *_counts(models))
    stream = replies.writeStream.format("parquet").option("path", f"{store}/replies").option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start()
    told = -1
    while True:
        ended = stream.awaitTermination(1)
        for p in stream.recentProgress if progress else []:
            if p["batchId"] > told and p["observedMetrics"].get("asked"):
                told, got = p["batchId"], p["observedMetrics"]["asked"]
                progress({"batch": told, "models": {m: {c: int(got[f"{c}_{i}"] or 0) for c in COUNTS} for i, m in enumerate(models or [""])}})
        if ended:
            return


def ask(
    rows: DataFrame,
    prompt: str,
    model: str,
    client: dict[str, Service] | Callable[[], Client],
    name: str = "reply",
    threads: int = 8,
    partitions: int = 8,
    tries: int = 3,
    first_delay: float = 1.0,
    most_delay: float = 30.0,
    accept: Callable[[str], bool] | None = None,
    store: str | None = None,
    run: int = 0,
    batch_rows: int = 1000,
    batch_files: int = 64,
    progress: Callable[[dict], None] | None = None,
) -> DataFrame:
    """rows with `name` and `name`_error; a null prompt is not sent, equal ones of a model once.

    client: the service of each model by its name (see services), or a factory of one client for all, for which threads and
    partitions bound the calls. accept tells whether a reply will do; store is the folder of tasks and replies (a new one below
    the shared folder, if none is given); run numbers repeats of the same prompts. A batch is of batch_files files of
    batch_rows prompts at most, or a part in MOST_BATCHES of the store's files if that is more; progress is told of each (see drain).
    """
    spark = rows.sparkSession
    lasting, store = store is not None, store or scratch(spark, "replies")
    known = client if isinstance(client, dict) else {"": Service(lambda settings: client(), {}, "", partitions, threads)}
    settings = {m: json.dumps(s.settings, sort_keys=True, ensure_ascii=False) for m, s in known.items() if s.settings}
    own = rows.withColumns({"_model": F.col(model)})
    shown = F.create_map(*[F.lit(x) for pair in settings.items() for x in pair]) if settings else None
    told = [F.try_element_at(shown, F.col("_model"))] if settings else []
    served = F.lit(True) if "" in known else F.col("_model").isin(*known) if known else F.lit(False)
    own = own.withColumn("ask_key", F.when(F.col(prompt).isNotNull() & served, F.sha2(F.concat_ws("\n", F.lit(str(run)), "_model", *told, prompt), 256)))
    how = {"tries": tries, "first_delay": first_delay, "most_delay": most_delay, "accept": accept}
    finish = functools.partial(drain, spark, store, known, batch_files, progress, **how)
    if lasting and not _stored(spark, f"{store}/tasks", TASKS).isEmpty():
        finish()
    wanted = own.filter("ask_key is not null").select("ask_key", F.col("_model").alias("model"), F.col(prompt).alias("prompt")).dropDuplicates(["ask_key"])
    if lasting:
        wanted = wanted.join(stored_replies(spark, store).filter("good").select("ask_key"), "ask_key", "left_anti")
    wanted.write.mode("append").option("maxRecordsPerFile", batch_rows).parquet(f"{store}/tasks")
    finish()
    # A new store holds one reply of each prompt.
    found = stored_replies(spark, store) if lasting else _stored(spark, f"{store}/replies", REPLIES)
    if lasting:
        # A table of its own: later calls add to the store, and two reads of one path may be taken for the same.
        path = scratch(spark, "replies")
        found.join(own.select("ask_key").distinct(), "ask_key", "left_semi").write.parquet(path)
        found = spark.read.schema(found.schema).parquet(path)
    # Rows without a prompt get keys of their own, so that they do not meet in one task.
    spread = F.coalesce("ask_key", F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string")))
    found = found.select(F.col("ask_key").alias("_key"), F.col("reply").alias(name), F.col("error").alias(f"{name}_error"))
    # Why a row has no key is told before the join, which then need not carry the prompts.
    missing = F.when(F.col(prompt).isNull(), F.lit("no prompt")).otherwise(F.lit("no client serves this model"))
    out = own.withColumns({"_key": spread, "_missing": F.when(F.col("ask_key").isNull(), missing)}).join(found, "_key", "left")
    out = out.withColumn(f"{name}_error", F.coalesce("_missing", f"{name}_error"))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], name, f"{name}_error")

"""Incremental judging: new candidates from a folder of JSON Lines, judged and written once each."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quillon.sources.readers import read_jsonl
from quillon.sources.shared import files_a_batch
from quillon.sources.writers import write_jsonl

KEY = ("sample_id", "candidate_id")
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Once(StatefulProcessor):
    """The first row of each key; that a key is done is all the state there is."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", "done boolean")

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self.done.update((True,))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = next(rows, None)
        if first is not None and not self.done.exists():
            self.done.update((True,))
            yield first

    def close(self) -> None:
        pass


def judge_stream(spark: SparkSession, source: str, schema: str, judge: Callable[[DataFrame], DataFrame], target: str, target_schema: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Judges what files in source hold and adds it to target, batch by batch until all is read.

    Which pairs of sample and candidate are done is the stream's state, kept by key; a new checkpoint begins with those that the
    target holds, and no later batch reads the target. A batch's rows are a folder of its own, named by the checkpoint and the
    batch's number, so a batch that is repeated after a failure replaces what it wrote. A batch is of files_per_batch files, or a part
    in MOST_BATCHES of the source's files if that is more.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch(spark, source, "json", files_per_batch)).json(source)
    done = read_jsonl(spark, target, target_schema, bad="skip").select(*KEY).distinct()
    new = stream.groupBy(*KEY).transformWithState(Once(), stream.schema, "Append", "None", done.groupBy(*KEY))

    def one(batch: DataFrame, number: int) -> None:
        write_jsonl(judge(batch), f"{target}/batch={name}-{number}")

    return new.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

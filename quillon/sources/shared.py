"""The folder that driver and executors share, and tables that are written there once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Batches that the files of a stream make at most: beyond that, batches grow, since each has costs of its own.
MOST_BATCHES = 32


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name below spark.checkpoint.dir, which driver and executors share.

    Where the session names none, a session of one machine (as in tests) gets a local folder; on a cluster it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-scratch-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows written once below the shared folder and read back: what follows does not work them out again."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def files_a_batch(spark: SparkSession, path: str, kind: str, least: int) -> int:
    """Files that a batch of a stream over this folder takes: `least`, or more where its files would make over MOST_BATCHES batches."""
    try:
        held = len(spark.read.format(kind).schema("x string").load(path).inputFiles())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        held = 0
    return max(least, -(-held // MOST_BATCHES))


def slices(batch: pa.RecordBatch | pa.Array, texts: pa.Array, limit: int = 1 << 20) -> Iterator[pa.RecordBatch | pa.Array]:
    """A batch in slices whose texts sum up to about limit bytes (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    marks = (np.cumsum(sizes + 16) - 1) // limit
    cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)

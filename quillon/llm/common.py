"""Helpers shared by the corpus operators: table reads, the shared folder, its files, and chunked Arrow iteration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillon.sources.writers import scratch as shared_dir

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task holds as one chunk (a document longer than that is a chunk of its own).
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_files(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, and the folder's path there; the folder is made."""
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    return fs, path


def materialized(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: cuts lineage, and what follows survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialized() wrote and that nothing to come reads."""
    for each in tables:
        fs, path = shared_files(each.shared_path)
        fs.delete_dir(path)


def words_count(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(docs: DataFrame, *names: str) -> DataFrame:
    """docs without the columns that have one of these names in any case."""
    taken = {x.lower() for x in names}
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])


def with_fields(docs: DataFrame, ddl: str) -> StructType:
    """The schema of docs with these fields behind."""
    return StructType([*docs.schema.fields, *StructType.fromDDL(ddl).fields])


def with_columns(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """docs with these columns; input columns whose names clash (in any case) are replaced."""
    taken = {c.lower() for c in columns}
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken], *[v.alias(k) for k, v in columns.items()])


def boxed(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """These columns beside each row of docs as the one struct _row, so that no name of a column clashes with another."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *columns)


def unboxed(df: DataFrame, names: list[str], columns: dict[str, Column]) -> DataFrame:
    """The columns of these names out of _row with these columns behind; those whose names clash (in any case) are replaced."""
    taken = {c.lower() for c in columns}
    return df.select(*[F.col(f"_row.`{c}`").alias(c) for c in names if c.lower() not in taken], *[v.alias(k) for k, v in columns.items()])


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose values in this column sum up to about limit bytes (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    if not len(sizes):
        return
    marks = (np.cumsum(sizes + 16) - 1) // limit
    cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings; null is empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def utf8_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]

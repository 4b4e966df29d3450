"""Sinks: JSON Lines and CSV, overwritten or appended, runs of repeats, and paths of derived files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.incremental import manual_upsert, resume_pending
from quillon.sources.shared import scratch, stored

__all__ = ["append_csv", "append_new", "manual_path", "merge_manual", "read_all_repeats", "repeat_path", "scratch", "stored", "write_jsonl", "write_manual", "write_patch", "write_repeats", "write_stats"]


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a row, nulls kept."""
    rows.write.mode(mode).json(path, ignoreNullFields=False)


def append_new(rows: DataFrame, path: str, done: DataFrame) -> None:
    """Rows whose (sample_id, candidate_id) is not done yet, appended; a second run of the same rows adds nothing."""
    write_jsonl(resume_pending(rows, done), path, "append")


def append_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").csv(path, header=True, quoteAll=True, escape='"')


def write_repeats(rows: DataFrame, path: str) -> None:
    """Runs below one folder, one directory for each repeat_idx, so a reader can prune them."""
    rows.write.mode("overwrite").partitionBy("repeat_idx").json(path, ignoreNullFields=False)


def write_manual(existing: DataFrame, new: DataFrame, path: str) -> None:
    """Human-rank rows merged by (sample_id, source_file) and written to a path other than the one they were read from."""
    write_jsonl(manual_upsert(existing, new, "sample_id", "source_file"), path)


def merge_manual(old: DataFrame, new: DataFrame, path: str) -> None:
    """Like write_manual, with old as read_jsonl_lines gives it: its lines that are no JSON are written again as they were."""
    good = old.filter("_raw is null").drop("_raw", "_file", "_line_no")
    merged = manual_upsert(good, new.select(good.columns), "sample_id", "source_file")
    lines = merged.select(F.to_json(F.struct(*[f"`{c}`" for c in good.columns]), {"ignoreNullFields": "false"}).alias("value"))
    lines.union(old.filter("_raw is not null").select("_raw")).write.mode("overwrite").text(path)


def write_patch(raw: DataFrame, zero: DataFrame, path: str) -> None:
    """The raw rows of these samples as a folder of CSV files, sample_id first."""
    own = raw.join(zero.select("sample_id"), "sample_id", "left_semi")
    own.select("sample_id", *[f"`{c}`" for c in raw.columns if c not in ("sample_id", "_ordinal")]).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def write_stats(stats: DataFrame, path: str) -> None:
    """A report as JSON Lines and as CSV."""
    write_jsonl(stats, f"{path}/stats.jsonl")
    stats.write.mode("overwrite").csv(f"{path}/stats.csv", header=True)


def repeat_path(path: str, run: int) -> str:
    folder, _, name = path.rpartition("/")
    stem, dot, suffix = name.partition(".")
    return f"{folder}/{stem}_repeats/{stem}_repeat{run}{dot}{suffix}".lstrip("/") if not folder else f"{folder}/{stem}_repeats/{stem}_repeat{run}{dot}{suffix}"


def manual_path(path: str) -> str:
    stem, dot, suffix = path.rpartition(".")
    return f"{stem}_rank_manually{dot}{suffix}" if dot else f"{path}_rank_manually.jsonl"


def read_all_repeats(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The runs that write_repeats wrote, with repeat_idx."""
    return spark.read.schema(f"{schema}, repeat_idx int").json(path).withColumn("repeat_idx", F.col("repeat_idx").cast("int"))

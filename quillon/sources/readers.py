"""Sources: question CSVs, JSON Lines with three ways to treat bad lines, JSON documents, Parquet, folders of results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.functions.text import filled, text_or_empty
from quillon.sources.csv_ranges import RANGE, read_ranges, readable

#: CSV headers that are renamed, and the two families of reference answers.
RENAMED = {"一级分类": "category_level1", "二级分类": "category_level2", "三级分类": "category_level3"}
OPTIONAL = ("domain", "last_query", "data", "suggest", "rag", "service", "last_answer_phone", "winner")
FAMILIES = (("a_answer", "b_answer"), ("answer_phone", "think_phone"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings; cells may hold line breaks."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"', mode="PERMISSIVE")


def reference_answers(columns: list[str]) -> Column:
    """Answers of the family that the header has, without empty ones; null if none are left."""
    family = next((f for f in FAMILIES if any(c in columns for c in f)), FAMILIES[1])
    pairs = [x for c in family for x in (F.lit(c), F.col(c) if c in columns else F.lit(None).cast("string"))]
    held = F.map_filter(F.create_map(*pairs), lambda k, v: text_or_empty(v) != "")
    return F.when(F.size(held) > 0, held)


def samples_from(rows: DataFrame, ordinal: Column) -> DataFrame:
    """Samples of raw rows (all strings): renamed columns, missing ones null, ids from the column or the row number."""
    if "query" not in rows.columns:
        raise ValueError("column query is missing")
    own = rows.withColumn("_ordinal", ordinal)
    pick = lambda c: F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string")
    sample_id = F.coalesce(pick("sample_id"), (F.col("_ordinal") + 1).cast("string"))
    levels = [pick(raw).alias(name) for raw, name in RENAMED.items()]
    return own.select(sample_id.alias("sample_id"), text_or_empty("query").alias("query"), *levels, *[pick(c).alias(c) for c in OPTIONAL], reference_answers(rows.columns).alias("reference_answers"), "_ordinal")


def numbered_csv(spark: SparkSession, path: str, range_bytes: int = RANGE) -> tuple[list[str], DataFrame]:
    """The columns of a CSV, or of a folder of CSVs in the order of their names, and its rows with their number from 0 on (_at).

    Files are read by ranges of bytes, in as many tasks; those in a store that only Spark can open, by one task each.
    """
    rows = read_csv(spark, path)
    names = rows.columns
    if names and readable(spark, path):
        return names, read_ranges(spark, path, names, range_bytes)
    return names, _numbered_files(rows)


def _numbered_files(rows: DataFrame) -> DataFrame:
    """rows with their number (_at): a file whose cells hold line breaks is read by one task, so its row ids are the order
    within the file; the rows of earlier files are added."""
    names = rows.columns
    if len(rows.inputFiles()) <= 1:
        return rows.withColumn("_at", F.monotonically_increasing_id())
    rows = rows.withColumns({"_file": F.input_file_name(), "_row": F.monotonically_increasing_id()})
    files = rows.groupBy("_file").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(files.select("_file", "_first", before.alias("_before")), "_file")
    return rows.select(*[F.col(f"`{c}`") for c in names], (F.col("_row") - F.col("_first") + F.col("_before")).alias("_at"))


def scan_samples(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Samples of a CSV, or of a folder of CSVs, numbered in order."""
    _, rows = numbered_csv(spark, path)
    out = samples_from(rows, F.col("_at"))
    return out.filter(F.col("_ordinal") < max(max_rows, 0)) if max_rows else out


def raw_samples(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a CSV as they are, with the sample_id that scan_samples gives them."""
    names, rows = numbered_csv(spark, path)
    number = (F.col("_at") + 1).cast("string")
    own = F.coalesce(F.col("sample_id"), number) if "sample_id" in names else number
    return rows.select(own.alias("sample_id"), *[F.col(f"`{c}`") for c in names if c != "sample_id"])


def check_unique_ids(samples: DataFrame) -> DataFrame:
    """The samples; fails if two of them share an id."""
    twice = samples.groupBy("sample_id").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"sample_id {twice[0]['sample_id']!r} is not unique")
    return samples


def read_jsonl(spark: SparkSession, path: str, schema: str, bad: str = "fail") -> DataFrame:
    """JSON Lines. bad: fail, skip, or keep (then _raw holds a line that is no JSON); a missing path gives no rows."""
    mode = {"fail": "FAILFAST", "skip": "DROPMALFORMED", "keep": "PERMISSIVE"}[bad]
    ddl = f"{schema}, _raw string" if bad == "keep" else schema
    try:
        return spark.read.schema(ddl).json(path, mode=mode, columnNameOfCorruptRecord="_raw" if bad == "keep" else None)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files (value) with their file (_file) and number within it from 1 on (_line_no).

    A file may be read in several splits: each split counts its lines, and the counts of earlier ones are added.
    """
    place = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    lines = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("_row"))
    splits = lines.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return lines.join(splits, ["_file", "_block"]).select("value", "_file", (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias("_line_no"))


def read_jsonl_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines with the place of each (_file, _line_no); a line that is no JSON is kept in _raw, blank ones are skipped."""
    lines = numbered_lines(spark, path).filter(filled("value"))
    parsed = F.from_json("value", f"{schema}, _raw string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"})
    return lines.select(parsed.alias("_p"), "_file", "_line_no").select("_p.*", "_file", "_line_no")


def read_stage(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that an earlier stage wrote as JSON Lines; a missing or empty path is an error."""
    rows = read_jsonl(spark, path, schema)
    if rows.isEmpty():
        raise ValueError(f"{path} is missing or empty: run the stage that writes it first")
    return rows


def result_files(spark: SparkSession, folder: str) -> list[str]:
    """JSON Lines and JSON files below a folder, sorted."""
    return sorted(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{jsonl,json}").text(folder).inputFiles())


def default_file(files: list[str]) -> str | None:
    """The first file with results on the deduction scale, else with results at all, else the first one."""
    return next((f for mark in ("judge_results_kto", "judge_results", "") for f in files if mark in f), None)


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A whole file as one JSON value: a list gives its items, an object one row."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_results(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All JSON Lines and JSON files below a folder, with the file of each row."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.{jsonl,json}").json(folder).withColumn("_file", F.input_file_name())


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def guess_column(columns: list[str], candidates: list[str], chosen: str | None = None) -> str:
    """The chosen column, else the first candidate that exists."""
    found = chosen or next((c for c in candidates if c in columns), None)
    if found not in columns:
        raise ValueError(f"none of {candidates} is a column" if chosen is None else f"{chosen} is no column")
    return found


def scan_two_answers(spark: SparkSession, path: str, query: str | None = None, a: str | None = None, b: str | None = None) -> DataFrame:
    """query, answer_a, answer_b and all other columns of a two-answer CSV, or of a folder of CSVs, with the number of the row; only CSV is read."""
    if path.lower().endswith((".xls", ".xlsx")):
        raise ValueError("spreadsheets are not read; give a CSV")
    columns, rows = numbered_csv(spark, path)
    names = [guess_column(columns, c, x) for c, x in ((["query", "question"], query), (["a_answer", "answer_a", "answer_phone"], a), (["b_answer", "answer_b", "think_phone"], b))]
    chosen = dict(zip(names, ("query", "answer_a", "answer_b")))
    return rows.select(F.col("_at").alias("_source_row_index"), *[text_or_empty(c).alias(chosen[c]) if c in chosen else F.col(f"`{c}`") for c in columns])

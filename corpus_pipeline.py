"""The corpus pipeline: five stages, each a call of one corpus operator on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.bpe import round_trip
from quillon.llm.common import materialized, with_columns
from quillon.llm.langid import UNKNOWN, fit, identify
from quillon.llm.mixing import mixed
from quillon.llm.neardup import drop_near_duplicates
from quillon.llm.substring import drop_duplicate_spans

#: Predictions below this score say that a text is of none of the learned languages.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (or text) and those whose language the network cannot tell.

    Null ids, languages and sources stay as they are, repeated rows are judged alike, long texts by all their windows; without a
    labelled document nothing can be told and nothing stays.
    """
    found = identify(docs, fit(docs)).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return found.select(*[f"`{c}`" for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates (five-word shingles, similarity 0.8 or more) the document with the smallest doc_id.

    Rows without an id are in no group and all stay; of repeated rows one stays; texts without words are alike.
    """
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages that start in a document of smaller doc_id out of the texts; other texts stay as they are.

    A null text stays null; a text that is taken whole is empty; repeated rows keep what one of them keeps; a null id is larger
    than any other. n_chars follows the text.
    """
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    out = with_columns(drop_duplicate_spans(docs), {"text": text})
    if "n_chars" in docs.columns:
        out = with_columns(out, {"n_chars": F.when(F.col("text").isNotNull(), F.length("text").cast("long"))})
    return out.select(*[f"`{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix, each as often as it is taken.

    Rows without words are never taken; a null source is a source of its own; rows without an id are taken like others; the row
    at the end of a fractional epoch is cut behind its last word, and its n_chars follows.
    """
    return mixed(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row (little-endian unsigned 32-bit), and digests of them and of the text they decode to.

    A null text is empty and has no ids; repeated rows give equal rows; an empty table gives none, as in every stage.
    """
    out = round_trip(docs.select("doc_id", "source", "text"))
    n = F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens")
    return out.select("doc_id", "source", n, "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup), ("substring_dedup", substring_dedup), ("mix_sources", mix_sources), ("bpe", bpe)]

#: No SQL: three stages are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

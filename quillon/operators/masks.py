"""Which configured models each sample has candidates of, as bit masks of one aggregation.

A bit stands for a configured model; a mask is an array of words of WORD_BITS bits. Completeness, what to generate and what to
repair are then operations on masks, without a product of samples and models and without joins of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import is_placeholder

#: Bits of a word: those of a long without its sign.
WORD_BITS = 63


def _models(configured: DataFrame) -> list[tuple[str, str]]:
    """The configured models in order; they come from a file, whose size does not follow the data."""
    return sorted((r.model_type, r.model_name) for r in configured.select("model_type", "model_name").distinct().collect() if r.model_type is not None and r.model_name is not None)


def _full(n: int) -> list[int]:
    """The words of a mask of all n models."""
    return [(1 << min(WORD_BITS, n - at)) - 1 for at in range(0, n, WORD_BITS)]


def model_masks(configured: DataFrame, candidates: DataFrame, samples: DataFrame | None = None) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(sample_id, is_sample, have, good) by sample, and the models that the bits stand for: of which models there is a candidate,
    and one that is no placeholder. Samples without candidates come in if they are given, and only those are marked is_sample.

    One aggregation over candidates and samples together, with masks combined before the shuffle.
    """
    models = _models(configured)
    rows = [(*m, i // WORD_BITS, 1 << (i % WORD_BITS)) for i, m in enumerate(models)]
    bits = F.broadcast(candidates.sparkSession.createDataFrame(rows, "model_type string, model_name string, _word int, _bit long"))
    good = F.when(is_placeholder(F.col("response")), F.lit(0)).otherwise(F.col("_bit")) if "response" in candidates.columns else F.col("_bit")
    # A left join keeps samples whose candidates are all of other models.
    met = candidates.join(bits, ["model_type", "model_name"], "left").select("sample_id", F.lit(False).alias("is_sample"), "_word", "_bit", good.alias("_good"))
    if samples is not None:
        none = F.lit(None)
        met = met.union(samples.select("sample_id", F.lit(True), none.cast("int"), none.cast("long"), none.cast("long")))
    n = len(_full(len(models)))
    words = lambda c: F.array(*[F.coalesce(F.bit_or(F.when(F.col("_word") == w, F.col(c))), F.lit(0).cast("long")) for w in range(n)]) if n else F.array().cast("array<bigint>")
    return met.groupBy("sample_id").agg(F.bool_or("is_sample").alias("is_sample"), words("_bit").alias("have"), words("_good").alias("good")), models


def holds_all(mask: Column | str, models: list) -> Column:
    """Whether a mask has the bits of all models."""
    column = F.col(mask) if isinstance(mask, str) else mask
    return reduce(Column.__and__, [column[i] == F.lit(w) for i, w in enumerate(_full(len(models)))], F.lit(True))


def missing(mask: str, models: list[tuple[str, str]]) -> Column:
    """The models whose bit a mask lacks, as an array of structs."""
    each = [F.struct(F.lit(t).alias("model_type"), F.lit(m).alias("model_name"), F.lit(i // WORD_BITS).alias("word"), F.lit(1 << (i % WORD_BITS)).cast("long").alias("bit")) for i, (t, m) in enumerate(models)]
    table = F.array(*each) if each else F.array().cast("array<struct<model_type: string, model_name: string, word: int, bit: bigint>>")
    return F.filter(table, lambda m: F.get(F.col(mask), m["word"]).bitwiseAND(m["bit"]) == 0)

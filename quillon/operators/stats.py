"""Statistics of scores, lengths and candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.ordinals import exact_quantiles


def model_key() -> Column:
    """Type and name as one text; a slash in the type is escaped, so that no two models share a key."""
    kind = F.replace(F.replace(F.coalesce("model_type", F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("/"), F.lit("\\/"))
    return F.concat(kind, F.lit("/"), F.coalesce("model_name", F.lit("")))


def model_stats(results: DataFrame) -> DataFrame:
    """By model: count, mean, population deviation, least and greatest score; a missing score is 0."""
    s = F.coalesce("aggregate_score", F.lit(0.0))
    return results.groupBy(model_key().alias("model")).agg(F.count("*").alias("count"), F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"))


def score_medians(results: DataFrame) -> DataFrame:
    """By model: the exact median score. No task holds all scores of a model."""
    return exact_quantiles(results.select(model_key().alias("model"), "aggregate_score"), ["model"], "aggregate_score", {"median": 0.5})


def score_quantiles(results: DataFrame) -> DataFrame:
    """By model: exact quartiles and ends of the scores."""
    return exact_quantiles(results.select(model_key().alias("model"), "aggregate_score"), ["model"], "aggregate_score", {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0})


def length_stats(candidates: DataFrame) -> DataFrame:
    """By model: characters of the responses."""
    n = F.length(F.coalesce("response", F.lit(""))).cast("long")
    return candidates.groupBy("model_name").agg(F.count("*").alias("count"), F.avg(n).alias("avg_length"), F.min(n).alias("min_length"), F.max(n).alias("max_length"))


def candidates_per_sample(candidates: DataFrame) -> DataFrame:
    """One row: the least, greatest and mean number of candidates of a sample."""
    each = candidates.groupBy("sample_id").agg(F.count("*").alias("n"))
    return each.agg(F.min("n").alias("min_candidates"), F.max("n").alias("max_candidates"), F.avg("n").alias("avg_candidates"))


def histogram(values: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin from 1, n) of equal bins from the least to the greatest value, the last one closed; a single value lies in the middle.

    The bounds are scalar subqueries; bins are counted before the shuffle.
    """
    low, high = values.agg(F.min(column)).scalar(), values.agg(F.max(column)).scalar()
    own = values.filter(F.col(column).isNotNull()).select(F.col(column).alias("_x"), low.alias("_lo"), high.alias("_hi"))
    half = F.when(F.col("_lo") == F.col("_hi"), 0.5).otherwise(0.0)
    # The share of the range comes first: width_bucket multiplies before it divides, which puts some values on a bound elsewhere.
    share = (F.col("_x") - (F.col("_lo") - half)) / ((F.col("_hi") + half) - (F.col("_lo") - half))
    place = (F.floor(F.least(share * bins, F.lit(bins - 1.0))) + 1).cast("long")
    return own.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))


def check_mean(checks: Column) -> Column:
    """Mean of the scores that are numbers; 0 without any."""
    scores = F.filter(F.transform(checks, lambda c: c["score"].try_cast("double")), lambda x: x.isNotNull())
    return F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores)).otherwise(0.0)


def distinct_models(results: DataFrame) -> DataFrame:
    return results.select("model_name").distinct()

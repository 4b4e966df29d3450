"""Ranks, preference pairs and the trust in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _by_sample():
    return W.partitionBy("sample_id")


def rank_candidates(scores: DataFrame) -> DataFrame:
    """sample_id, candidate_id, aggregate_score and rank: descending score, ties by _pos, no equal ranks."""
    order = _by_sample().orderBy(F.desc("aggregate_score"), "_pos")
    return scores.select("sample_id", "candidate_id", "aggregate_score", F.row_number().over(order).alias("rank"))


def top_bottom_k(ranked: DataFrame, top_k: int = 1, bottom_k: int = 1) -> tuple[DataFrame, DataFrame]:
    """The first and the last of each sample by rank."""
    last = F.row_number().over(_by_sample().orderBy(F.desc("rank")))
    return ranked.filter(F.col("rank") <= top_k), ranked.withColumn("_last", last).filter(F.col("_last") <= bottom_k).drop("_last")


def wide_enough(ranked: DataFrame, least: float) -> DataFrame:
    """Ranked rows of samples whose best and worst score differ by at least this much."""
    spread = F.max("aggregate_score").over(_by_sample()) - F.min("aggregate_score").over(_by_sample())
    return ranked.withColumn("_spread", spread).filter(F.col("_spread") >= least).drop("_spread")


def preference_pairs(ranked: DataFrame, top_k: int = 1, bottom_k: int = 1, min_score_diff: float = 0.0, exclude_self: bool = False) -> DataFrame:
    """sample_id, positive, negative: each of the first k with each of the last k.

    One window pass bounds every sample to its first and last k rows and spread; both sides of a pair then come from one
    small array for each sample, so nothing is joined.
    """
    w = _by_sample()
    marked = ranked.select("sample_id", "candidate_id", "rank", F.count("*").over(w).alias("_n"), (F.max("aggregate_score").over(w) - F.min("aggregate_score").over(w)).alias("_spread"))
    ends = marked.filter((F.col("_spread") >= min_score_diff) & ((F.col("rank") <= top_k) | (F.col("rank") > F.col("_n") - bottom_k)))
    item = F.struct("rank", "candidate_id")
    sides = ends.groupBy("sample_id").agg(F.collect_list(F.when(F.col("rank") <= top_k, item)).alias("top"), F.collect_list(F.when(F.col("rank") > F.col("_n") - bottom_k, item)).alias("bottom"))
    pairs = sides.select("sample_id", F.explode("top").alias("p"), "bottom").select("sample_id", "p", F.explode("bottom").alias("q"))
    pairs = pairs.select("sample_id", F.col("p.candidate_id").alias("positive"), F.col("q.candidate_id").alias("negative"))
    return pairs.filter("positive <> negative") if exclude_self else pairs


def rich_pairs(pairs: DataFrame, candidates: DataFrame, samples: DataFrame) -> DataFrame:
    """Pairs with both responses and scores, and the sample's context and question."""
    side = lambda name: candidates.select("sample_id", F.col("candidate_id").alias(name), F.col("response").alias(f"{name}_response"), F.col("aggregate_score").alias(f"{name}_score"))
    return pairs.join(side("positive"), ["sample_id", "positive"]).join(side("negative"), ["sample_id", "negative"]).join(samples.select("sample_id", "context", "question"), "sample_id")


def rank_agreement(scores: DataFrame) -> DataFrame:
    """Of each sample whether ground and structure scores give the same order."""
    place = lambda c: F.row_number().over(_by_sample().orderBy(F.desc(c), "_pos"))
    both = scores.withColumn("_g", place("ground_score")).withColumn("_s", place("structure_score"))
    return both.groupBy("sample_id").agg(F.min(F.when(F.col("_g") == F.col("_s"), 1).otherwise(0)).cast("boolean").alias("agrees"))


def trustworthy(scores: DataFrame, least: float, agreement: DataFrame | None = None) -> DataFrame:
    """sample_id, spread and whether its ranks can be trusted: a wide enough spread and, if given, agreeing orders."""
    spread = scores.groupBy("sample_id").agg((F.max("aggregate_score") - F.min("aggregate_score")).alias("spread"))
    ok: Column = F.col("spread") >= least
    if agreement is not None:
        spread, ok = spread.join(agreement, "sample_id"), ok & F.col("agrees")
    return spread.select("sample_id", "spread", ok.alias("is_rank_trustworthy"))


def sort_results(results: DataFrame, score: str = "aggregate_score") -> DataFrame:
    """Descending by score; what is no number comes first; ties by _pos."""
    return results.orderBy(F.desc_nulls_first(F.col(score).try_cast("double")), "_pos")

"""From judges' findings to deductions, totals, labels and weights.

Penalties are rows (answer, source, _pos, rule_id, score, reason, excerpt). Source and position keep the order in which lists
were joined, so "the first of equal ones wins" has a meaning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.functions import scoring as S
from quillon.functions.text import has_markdown

#: Words one of which an answer about a graded sleep score must have. Fixed values.
GRADE_WORDS = ("优", "良", "中", "差", "一般", "poor", "fair", "good")


def checks_to_penalties(checks: Column) -> Column:
    """Array of (rule_id, score, reason, excerpt): the findings that hit, with the deduction of their rule."""
    found = F.transform(
        F.filter(checks, lambda c: F.coalesce(c["hit"], F.lit(False))),
        lambda c: F.struct(
            F.upper(F.coalesce(c["rule_id"], F.lit(""))).alias("rule_id"),
            S.check_score(F.upper(F.coalesce(c["rule_id"], F.lit(""))), c["severity"]).alias("score"),
            F.coalesce(c["reason"], F.lit("")).alias("reason"),
            F.coalesce(c["excerpt"], F.lit("")).alias("excerpt"),
        ),
    )
    return F.filter(found, lambda p: p["score"].isNotNull())


def merge_penalties(*lists: DataFrame) -> DataFrame:
    """Penalty rows of several lists in this order (validators, ground, structure)."""
    return reduce(DataFrame.unionByName, [x.withColumn("source", F.lit(i)) for i, x in enumerate(lists)])


def dedup_keep_max(penalties: DataFrame, key: str = "answer") -> DataFrame:
    """One row of each answer and rule: the largest snapped score, the first of equal ones; scores that are no number go.

    _pos of the result is the place at which the rule first appeared.
    """
    own = penalties.withColumn("rule_id", F.upper(F.coalesce("rule_id", F.lit("")))).withColumn("score", S.snap_penalty(F.col("score"))).filter("score is not null")
    place = F.struct("source", "_pos") if "source" in penalties.columns else F.struct("_pos")
    # max_by is aggregated before the shuffle; negated places make the first of equal scores the greatest.
    rank = F.struct("score", *[(-place[c]).alias(c) for c in (("source", "_pos") if "source" in penalties.columns else ("_pos",))])
    kept = own.groupBy(key, "rule_id").agg(F.max_by(F.struct("score", "reason", "excerpt"), rank).alias("_p"), F.min(place).alias("_first"))
    return kept.select(key, "rule_id", "_p.score", "_p.reason", "_p.excerpt", "_first")


def total_scores(answers: DataFrame, kept: DataFrame, key: str = "answer", allow_negative: bool = False) -> DataFrame:
    """Answers with their total; an answer without penalties has the maximum."""
    sums = kept.groupBy(key).agg(F.sum("score").alias("_sum"))
    return answers.join(sums, key, "left").withColumn("total_score", S.total_score(F.col("_sum"), allow_negative)).drop("_sum")


def dimension_scores(answers: DataFrame, kept: DataFrame, key: str = "answer") -> DataFrame:
    """Answers with ground_score, structure_score (0 to 5) and aggregate_score, from the same penalties as the total."""
    part = lambda rules: F.sum(F.when(F.col("rule_id").isin(*rules), F.col("score")))
    sums = kept.groupBy(key).agg(part(S.GROUND).alias("_g"), part(S.STRUCTURE).alias("_s"), F.sum("score").alias("_t"))
    out = answers.join(sums, key, "left").withColumn("ground_score", S.dimension_score(F.col("_g"))).withColumn("structure_score", S.dimension_score(F.col("_s")))
    total = S.total_score(F.col("_t"))
    return out.withColumns({"total_score_20": total, "aggregate_score": total / S.MAX_SCORE * 5}).drop("_g", "_s", "_t")


def label_and_weight(scored: DataFrame, confidence: Column | None = None, **parameters) -> DataFrame:
    c = F.coalesce(confidence, F.lit(0.5)) if confidence is not None else F.lit(0.5)
    threshold = parameters.get("threshold", S.THRESHOLD)
    return scored.withColumns({"label": S.label(F.col("total_score"), threshold), "weight": S.weight(F.col("total_score"), c, **parameters)})


def average_confidence(*each: Column) -> Column:
    return S.clamp01(reduce(Column.__add__, each) / len(each))


def zero_penalty_guard(penalties: Column, answer: Column, graded: Column) -> Column:
    """The penalties, or, if there are none at all, those for an answer without Markdown or without a grade where one is due."""
    one = lambda rule, reason: F.struct(F.lit(rule).alias("rule_id"), F.lit(5.0).alias("score"), F.lit(reason).alias("reason"), F.lit("").alias("excerpt"))
    worded = reduce(Column.__or__, [F.contains(F.lower(answer), F.lit(x)) for x in GRADE_WORDS])
    least = F.array_compact(
        F.array(
            F.when(~has_markdown(answer), one("NO_MARKDOWN", "no Markdown structure")),
            F.when(F.coalesce(graded, F.lit(False)) & ~worded, one("PERSONAL_DATA_ANALYSIS_ISSUE", "a score and thresholds are given, but no grade is stated")),
        )
    )
    return F.when(F.size(penalties) > 0, penalties).otherwise(least)


def hit_checks(checks: Column) -> Column:
    """Checks that found something."""
    return F.filter(checks, lambda c: c["hit"])


def non_full_checks(checks: Column) -> Column:
    """Checks that give less than the full mark."""
    return F.filter(checks, lambda c: c["score"] < 5)

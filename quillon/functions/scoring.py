"""Deduction scoring as Column expressions: rules, penalty steps, totals, labels, weights, confidence, manual scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.text import strip

MAX_SCORE, THRESHOLD = 20.0, 12.0

# Rules by their deduction, steps, dimensions and confidence words.
RULES_20 = ("EMPTY_OR_INCOMPLETE", "ILLEGAL_CONTENT", "SENSITIVE_ADVICE", "PERSONAL_DATA_MISMATCH", "COURSE_LIB_MISSING", "NUM_COMPARE_ERROR", "ARITH_ERROR", "IRRELEVANT")
RULES_5 = ("NO_MARKDOWN", "BURIED_CORE_ANSWER", "THIN_CONTENT")
RULES_3 = ("REDUNDANT", "GRAMMAR", "UNNATURAL_TONE", "BAD_MARKDOWN_USAGE", "LACK_VISUAL_AID")
RULES_3_OR_5 = ("PERSONAL_DATA_ANALYSIS_ISSUE",)
RULES_5_OR_10 = ("CONTRADICT_KB_OR_EXPERT", "FACT_LOGIC_ISSUE")
GROUND = (
    "PERSONAL_DATA_MISMATCH", "COURSE_LIB_MISSING", "NUM_COMPARE_ERROR", "ARITH_ERROR", "CONTRADICT_KB_OR_EXPERT",
    "FACT_LOGIC_ISSUE", "IRRELEVANT", "MISSING_CHART_TABLE", "MISSING_SERVICE", "HALLUCINATION_VALUE",
)
STRUCTURE = (
    "EMPTY_OR_INCOMPLETE", "ILLEGAL_CONTENT", "SENSITIVE_ADVICE", "NO_MARKDOWN", "BAD_MARKDOWN_USAGE", "BURIED_CORE_ANSWER",
    "UNNATURAL_TONE", "LACK_VISUAL_AID", "THIN_CONTENT", "PERSONAL_DATA_ANALYSIS_ISSUE", "REDUNDANT", "GRAMMAR",
)
CONFIDENCE_WORDS = {
    "very high": 0.95, "high": 0.85, "medium": 0.6, "mid": 0.6, "low": 0.3, "very low": 0.1, "certain": 0.98, "uncertain": 0.4,
    "likely": 0.75, "unlikely": 0.25, "yes": 0.9, "no": 0.1, "true": 0.9, "false": 0.1,
}


def check_score(rule_id: Column, severity: Column) -> Column:
    """Deduction of a judge's finding; null for rules that a judge cannot raise."""
    s = F.lower(F.coalesce(severity, F.lit("")))
    return (
        F.when(rule_id.isin(*RULES_20), 20.0)
        .when(rule_id.isin(*RULES_5), 5.0)
        .when(rule_id.isin(*RULES_3), 3.0)
        .when(rule_id.isin(*RULES_3_OR_5), F.when(s.isin("5", "major"), 5.0).otherwise(3.0))
        .when(rule_id.isin(*RULES_5_OR_10), F.when(s.isin("major", "严重", "high"), 10.0).otherwise(5.0))
    )


def snap_penalty(score: Column) -> Column:
    """The nearest step of 20, 10, 5 and 3, the larger of two equally near; what is missing counts as 0; null for no number."""
    v = F.when(score.isNull(), F.lit(0.0)).otherwise(score.try_cast("double"))
    return F.when(v.isNotNull(), F.when(F.isnan(v) | (v >= 15), 20.0).when(v >= 7.5, 10.0).when(v >= 4, 5.0).otherwise(3.0))


def total_score(deductions: Column, allow_negative: bool = False) -> Column:
    total = F.lit(MAX_SCORE) - F.coalesce(deductions, F.lit(0.0))
    return total if allow_negative else F.greatest(F.lit(0.0), total)


def label(score: Column, threshold: float = THRESHOLD) -> Column:
    return F.when(score >= threshold, 1).otherwise(0)


def weight(score: Column, confidence: Column, threshold: float = THRESHOLD, delta: float = 0.5, gamma: float = 1.5, kappa: float = 0.5, least: float = 0.1, most: float = 5.0, span: float = MAX_SCORE) -> Column:
    """Grows with the distance from the threshold and with confidence, within [least, most]."""
    margin = F.greatest(F.lit(0.0), F.abs(score - threshold) - delta) / max(1e-6, span)
    return F.least(F.lit(most), F.greatest(F.lit(least), F.pow(margin, F.lit(gamma)) * (1 + kappa * confidence)))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def normalize_confidence(x: Column) -> Column:
    """A number, percentage or word as a value from 0 to 1; 0.5 for all else. x is a string."""
    s = F.lower(strip(F.coalesce(x, F.lit(""))))
    percent = F.regexp_replace(s, "%$", "").try_cast("double") / 100
    words = reduce(lambda w, kv: w.when(s == kv[0], kv[1]), list(CONFIDENCE_WORDS.items())[1:], F.when(s == list(CONFIDENCE_WORDS)[0], list(CONFIDENCE_WORDS.values())[0]))
    # NaN fails both comparisons of a clamp, so it ends as the upper bound.
    bounded = lambda v: F.when(F.isnan(v), 1.0).when(v.isNotNull(), clamp01(v))
    plain = s.try_cast("double")
    return F.when(F.endswith(s, F.lit("%")), F.coalesce(bounded(percent), F.lit(0.5))).otherwise(F.coalesce(words, bounded(plain), F.lit(0.5)))


def dimension_score(deductions: Column) -> Column:
    """0 to 5 from the deductions of one dimension's rules."""
    return F.greatest(F.lit(0.0), F.lit(MAX_SCORE) - F.coalesce(deductions, F.lit(0.0))) * 5 / MAX_SCORE


def manual_score(total: Column) -> Column:
    """0 to 5 from a total of 0 to 20; what is no number gives 0."""
    v = total.try_cast("double")
    return F.when(v.isNull() | F.isnan(v) | (v <= 0), 0).when(v >= 20, 5).when(v >= 16, 4).when(v >= 14, 3).when(v >= 12, 2).otherwise(1)


def clamped_manual(x: Column) -> Column:
    """A human's score if it is an integer from 0 to 5, else 0."""
    v = x.try_cast("int")
    return F.when(v.between(0, 5), v).otherwise(0)


def passes(total: Column, threshold: float = THRESHOLD) -> Column:
    v = total.try_cast("double")
    return F.coalesce(~F.isnan(v) & (v >= threshold), F.lit(False))


def mean_score(ground: Column, structure: Column) -> Column:
    """The score of an answer on the scale of means."""
    return (ground + structure) / 2


def aggregate_score(total: Column) -> Column:
    """A total out of 20 on the scale of 0 to 5."""
    return total / MAX_SCORE * 5

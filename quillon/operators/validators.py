"""Deterministic validators: penalties (arrays of structs) from an answer and the parsed data of its sample.

Parsed data is a struct (see DATA); sleep_thresholds keeps the order of the JSON object, because the first interval wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.text import bound, filled, number
from quillon.operators.penalties import GRADE_WORDS

DATA = "sleep struct<duration_hours: string, start: string, end: string, score: string, score_thresholds: string>, require_chart_or_table string, services string"
# Fixed values, on which results depend: what a Markdown table, a number of hours and a time of day look like.
TABLE = r"(?d)\n\|.+\|\n\|[-:\s|]+\|\n"
HOURS = r"(?iU)(\d+(?:\.\d+)?)\s*(?:h|小时)"
TIME = r"(?U)(\d{1,2}):(\d{2})"
_STRICT = {"allowSingleQuotes": "false"}


def parse_data(text: Column) -> Column:
    """The data JSON as a struct; null where the text is no JSON object or an empty one."""
    # Within brackets, text behind the object is an error or a second item.
    items = F.concat(F.lit("["), text, F.lit("]"))
    held = F.try_parse_json(items).isNotNull() & (F.json_array_length(items) == 1) & (F.size(F.json_object_keys(text)) > 0)
    return F.when(held, F.from_json(text, DATA, _STRICT))


def _penalty(rule: str, score: float, reason: Column | str, excerpt: Column | str = "") -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(F.lit(rule).alias("rule_id"), F.lit(score).alias("score"), lit(reason).alias("reason"), lit(excerpt).alias("excerpt"))


def _minutes(x: Column) -> Column:
    part = lambda k: F.regexp_extract(x, TIME, k).try_cast("int")
    return part(1) * 60 + part(2)


def sleep_target(data: Column) -> Column:
    """Hours of sleep: as given, or (missing or 0) from the first times of start and end, over midnight if need be."""
    sleep = data["sleep"]
    given = number(sleep["duration_hours"])
    gap = _minutes(sleep["end"]) - _minutes(sleep["start"])
    span = F.round(F.when(gap < 0, gap + 24 * 60).otherwise(gap) / 60.0, 2)
    return F.when(F.coalesce(given, F.lit(0.0)) != 0, given).otherwise(F.coalesce(span, given))


def sleep_duration(answer: Column, data: Column) -> Column:
    """The first 'number h' of the answer must be within a quarter of an hour of the target."""
    # The text is searched once: the number is taken out of what was found.
    return bound(F.struct(sleep_target(data).alias("target"), F.regexp_extract(answer, HOURS, 0).alias("found")), lambda x: _duration(x["target"], x["found"]))


def _duration(target: Column, found: Column) -> Column:
    said = F.regexp_extract(found, HOURS, 1).try_cast("double")
    wrong = F.when(F.abs(said - target) > 0.25, _penalty("PERSONAL_DATA_MISMATCH", 20.0, F.concat(F.lit("hours of sleep differ: "), said.cast("string"), F.lit(" and "), target.cast("string")), found))
    return F.array_compact(F.array(F.when(target.isNotNull(), F.when(found == "", _penalty("PERSONAL_DATA_ANALYSIS_ISSUE", 5.0, "hours of sleep are given, but not in the answer")).otherwise(wrong))))


def expected_grade(data: Column) -> Column:
    """The first grade whose interval [lo, hi) holds the score, or whose upper end equals it."""
    sleep = data["sleep"]
    score = number(sleep["score"])
    # Entries of a parsed map keep the order of the JSON object.
    entries = F.map_entries(F.from_json(sleep["score_thresholds"], "map<string, array<string>>", _STRICT))

    def holds(e: Column) -> Column:
        low, high = number(F.get(e["value"], F.lit(0))), number(F.get(e["value"], F.lit(1)))
        return F.coalesce(((low <= score) & (score < high)) | (F.abs(score - high) <= 1e-9 * F.greatest(F.abs(score), F.abs(high))), F.lit(False))

    return F.get(F.filter(entries, holds), F.lit(0))["key"]


def sleep_grade(answer: Column, data: Column) -> Column:
    """Where a grade follows from score and thresholds, the answer must name it or use one of the grade words."""

    def lacking(grade: Column) -> Column:
        named = lambda low: reduce(Column.__or__, [F.contains(low, F.lit(x)) for x in GRADE_WORDS], F.contains(low, F.lower(grade)))
        return F.when(~bound(F.lower(answer), named), _penalty("PERSONAL_DATA_ANALYSIS_ISSUE", 5.0, F.concat(F.lit("no grade is stated; expected: "), grade)))

    # The grade is worked out once: as an array's item it is a bound variable.
    due = F.filter(F.array(expected_grade(data)), lambda g: g.isNotNull() & (g != ""))
    return F.array_compact(F.transform(due, lacking))


def is_ungradable(data: Column) -> Column:
    """Whether there are thresholds for a score that is no number: such an answer cannot be judged."""
    score = data["sleep"]["score"]
    thresholds = F.coalesce(F.startswith(F.trim(data["sleep"]["score_thresholds"]), F.lit("{")), F.lit(False))
    return thresholds & score.isNotNull() & score.try_cast("double").isNull()


def is_graded(data: Column) -> Column:
    return data["sleep"]["score"].isNotNull() & data["sleep"]["score_thresholds"].isNotNull()


def chart(answer: Column, needed: Column) -> Column:
    """Where asked for, a Markdown table or an image must be there."""
    there = answer.rlike(TABLE) | F.contains(answer, F.lit("!["))
    return F.array_compact(F.array(F.when(F.coalesce(needed, F.lit(False)) & ~there, _penalty("MISSING_CHART_TABLE", 10.0, "a chart or table is asked for"))))


def chart_needed(data: Column) -> Column:
    """Whether the flag is true in Python's sense."""
    return ~F.coalesce(data["require_chart_or_table"], F.lit("")).isin("", "false", "0", "0.0", "[]", "{}")


def service(answer: Column, services: Column) -> Column:
    """Each service that is not blank must appear in the answer, in any case; the first six missing ones are named."""
    missing = bound(F.lower(answer), lambda low: F.filter(services, lambda s: filled(s) & ~F.contains(low, F.lower(s))))
    return bound(missing, _missing_services)


def _missing_services(missing: Column) -> Column:
    return F.array_compact(F.array(F.when(F.size(missing) > 0, _penalty("MISSING_SERVICE", 10.0, F.concat(F.lit("services not mentioned: "), F.array_join(F.slice(missing, 1, 6), ", "))))))


def run_validators(answer: Column, data: Column) -> Column:
    """All penalties in the order sleep, chart, service."""
    services = F.from_json(data["services"], "array<string>", _STRICT)
    return F.concat(sleep_duration(answer, data), sleep_grade(answer, data), chart(answer, chart_needed(data)), F.coalesce(service(answer, services), F.array().cast("array<struct<rule_id: string, score: double, reason: string, excerpt: string>>")))

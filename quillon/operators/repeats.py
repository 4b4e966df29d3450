"""Aggregation of repeated judgements: one row for each sample and candidate."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = ("candidate", "model_type", "model_name", "judge", "judge_meta", "_pos")
MEANS = ("aggregate_score", "total_score_20")
SHARES = ("label", "weight", "confidence")
LISTS = ("ground_score", "structure_score")
#: Parsed replies of the judges: structs of checks and confidence.
OUTPUTS = ("ground_output", "structure_output")


def _held(field: str) -> Column:
    """The runs that have this field, in their order."""
    return F.filter("_runs", lambda r: r[field].isNotNull())


def _values(field: str) -> Column:
    return F.transform(_held(field), lambda r: r[field])


def repeat_lines(field: str) -> Column:
    """'run: value' lines, runs counted from 1."""
    return F.array_join(F.transform(_held(field), lambda r: F.concat((r["repeat_idx"] + 1).cast("string"), F.lit(": "), r[field].cast("string"))), "\n")


def _with_run(items: Column, names: list[str], run: Column) -> Column:
    return F.transform(items, lambda x: F.struct(*[x[n].alias(n) for n in names], (run + 1).alias("repeat_idx")))


def merged_output(field: str, names: list[str]) -> Column:
    """The checks of all runs with their run from 1, and the confidence of each run; null where no run has an output."""
    checks = F.flatten(F.transform(_held(field), lambda r: F.coalesce(_with_run(r[field]["checks"], names, r["repeat_idx"]), F.array())))
    confidence = F.filter(F.transform(_held(field), lambda r: r[field]["confidence"]), lambda c: c.isNotNull())
    return F.when(F.size(_held(field)) > 0, F.struct(checks.alias("checks"), confidence.alias("confidence")))


def repeat_state(repeats: DataFrame, *by: str) -> DataFrame:
    """What runs come to by (sample_id, candidate_id), and `by`, in a form that further runs can be merged into: counts, sums, least
    values, the first run, and what is kept run by run, in order."""
    types = {f.name: f.dataType for f in repeats.schema}
    mine = lambda *names: [c for c in names if c in types]
    out = [F.count("*").alias("n_repeats"), F.min("repeat_idx").alias("_first_run")]
    if first := [c for c in mine(*FIRST) if c not in by]:
        out.append(F.min_by(F.struct(*first), "repeat_idx").alias("_first"))
    out += [F.min(c).alias(f"_min_{c}") for c in mine(*LISTS)]
    out += [f(c).alias(f"_{n}_{c}") for c in mine(*MEANS, *SHARES) for n, f in (("sum", F.sum), ("count", F.count))]
    out += [F.bool_and(c).alias(f"_all_{c}") for c, t in repeats.dtypes if t == "boolean"]
    # What is kept run by run is collected and put in order once.
    out.append(F.array_sort(F.collect_list(F.struct("repeat_idx", *mine(*LISTS, *MEANS, "notes", "penalties", *OUTPUTS)))).alias("_runs"))
    key = F.coalesce("candidate_id", *mine("candidate"), F.lit(""))
    return repeats.groupBy("sample_id", key.alias("candidate_id"), *by).agg(*out)


def merge_states(*states: DataFrame) -> DataFrame:
    """States of different runs as one state; the runs themselves are not read again."""
    held = read_all(states)
    keys = [c for c in held.columns if not c.startswith("_") and c != "n_repeats"]
    out = [F.sum("n_repeats").alias("n_repeats"), F.min("_first_run").alias("_first_run")]
    combine = {"_min_": F.min, "_sum_": F.sum, "_count_": F.sum, "_all_": F.bool_and}
    for c in held.columns:
        if c == "_first":
            out.append(F.min_by(c, "_first_run").alias(c))
        elif c == "_runs":
            out.append(F.array_sort(F.flatten(F.collect_list(c))).alias(c))
        elif f := next((f for start, f in combine.items() if c.startswith(start)), None):
            out.append(f(c).alias(c))
    return held.groupBy(*keys).agg(*out)


def read_all(states: tuple[DataFrame, ...]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, states)


def finished_repeats(state: DataFrame) -> DataFrame:
    """A state as what repeats come to: see repeat_aggregate."""
    runs = {f.name: f.dataType for f in state.schema["_runs"].dataType.elementType}
    first = state.schema["_first"].dataType.names if "_first" in state.columns else []
    of = lambda start: [c.removeprefix(start) for c in state.columns if c.startswith(start)]
    columns = {c: F.col(f"_first.{c}") for c in first}
    columns |= {c.replace("_score", "_min_score"): F.col(f"_min_{c}") for c in of("_min_")}
    columns |= {f"{c}_mean" if c == "label" else c: F.col(f"_sum_{c}") / F.nullif(F.col(f"_count_{c}"), F.lit(0)) for c in of("_sum_")}
    columns |= {c: F.col(f"_all_{c}") for c in of("_all_")}
    columns |= {c: _values(c) for c in LISTS if c in runs} | {f"{c}_list": _values(c) for c in MEANS if c in runs}
    columns |= {c: repeat_lines(c) for c in ("notes",) if c in runs}
    if "penalties" in runs:
        columns["penalties"] = F.flatten(F.transform(_held("penalties"), lambda r: _with_run(r["penalties"], runs["penalties"].elementType.names, r["repeat_idx"])))
    columns |= {c: merged_output(c, runs[c]["checks"].dataType.elementType.names) for c in OUTPUTS if c in runs}
    keys = [c for c in state.columns if not c.startswith("_")]
    return state.select(*keys, *[v.alias(k) for k, v in columns.items()])


def repeat_aggregate(repeats: DataFrame, *by: str) -> DataFrame:
    """By (sample_id, candidate_id), and `by`: scores of both dimensions as lists and least values, means with lists of the totals, means
    of label, weight and confidence, penalties with their run from 1, judges' outputs merged, notes as lines, and the
    candidate, the model and the judge of the first run."""
    return finished_repeats(repeat_state(repeats, *by))


def read_repeats(runs: list[DataFrame]) -> DataFrame:
    """Runs stacked with repeat_idx from 0."""
    out = runs[0].withColumn("repeat_idx", F.lit(0))
    for i, run in enumerate(runs[1:], 1):
        out = out.unionByName(run.withColumn("repeat_idx", F.lit(i)), allowMissingColumns=True)
    return out

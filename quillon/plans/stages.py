"""Stages of an evaluation run: generate, judge (two scales), rank, pairs, patch and repair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions import scoring as S
from quillon.functions.model_json import fenced_or_braced, first_to_last_brace, holds_checks, reply_parser
from quillon.functions.text import PLACEHOLDER, bound, candidate_id, text_or_empty
from quillon.operators import context as P
from quillon.operators.candidates import generated_rows, tasks
from quillon.operators.incremental import all_zero_samples, drop_failed, drop_failed_together, manual_rank_rows, patch_rows, repair_apply, repair_plan
from quillon.operators.penalties import average_confidence, checks_to_penalties, zero_penalty_guard
from quillon.operators.ranking import preference_pairs, rank_candidates
from quillon.operators.stats import check_mean
from quillon.operators.validators import is_graded, is_ungradable, parse_data, run_validators
from quillon.plans.models import Client, Service, ask
from quillon.schemas import PENALTY
from quillon.sources.readers import samples_from
from quillon.sources.writers import stored

PENALTIES = f"array<struct<{PENALTY}>>"
SYSTEM = "You answer questions with the given context."
#: Judge prompts. Both ask for JSON with one entry a rule.
GROUND_PROMPT = "Check the answer against the modules. Reply with JSON: checks (rule_id, hit, severity, score 0-5, reason, excerpt) and confidence.\n$modules\n\n$history\n$input\n\nAnswer:\n$answer"
STRUCTURE_PROMPT = "Check form, tone and completeness of the answer. Reply with JSON: checks (rule_id, hit, severity, score 0-5, reason, excerpt) and confidence.\n$history\n$input\n\nAnswer:\n$answer"


#: What answers: the service of each model, or a factory of one client for all.
Clients = dict[str, Service] | Callable[[], Client]
SIDES = ("ground", "structure")
#: What prompts of judges tell of a sample.
TOLD = ("input", "history", "modules")


def prompts(samples: DataFrame) -> DataFrame:
    """samples with the prompt that generators get."""
    messages = P.chat_messages(SYSTEM, P.context_text(), F.col("query"))
    return samples.withColumn("prompt", F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n"))


def generate(samples: DataFrame, models: DataFrame, client: Clients, **how) -> DataFrame:
    """A candidate of every configured model for every sample; a failed call gives the placeholder.

    Models of type reference answer with the sample's reference answers and are not called. The prompts of the samples are
    written once; a candidate's place is that of its model among all models.
    """
    own = stored(prompts(samples).select("sample_id", "reference_answers", "prompt"), "prompts")
    own = tasks(own, models.withColumn("_pos", F.dense_rank().over(Window.orderBy("model_type", "model_name"))))
    reference = F.col("model_type") == "reference"
    asked = ask(own.withColumn("prompt", F.when(~reference, F.col("prompt"))), "prompt", "model_name", client, "response", **how)
    picks = [F.nullif(F.try_element_at("reference_answers", F.lit(k)), F.lit("")) for k in ("a_answer", "b_answer", "answer_phone", "think_phone")]
    picked = F.coalesce(F.nullif(F.try_element_at("reference_answers", F.get_json_object("gen_config", "$.answer_key")), F.lit("")), *picks, F.lit(P.NONE_MARK))
    response = F.when(reference, picked).otherwise(F.coalesce("response", F.lit(PLACEHOLDER)))
    return asked.select("sample_id", candidate_id(F.col("sample_id"), F.col("model_name")).alias("candidate_id"), "model_type", "model_name", response.alias("response"), "gen_config", "_pos")


def ask_both(rows: DataFrame, client: Clients, accept: Callable[[str], bool], **how) -> DataFrame:
    """rows (judge, ground_prompt, structure_prompt) with the replies to both prompts, ground_raw and structure_raw, and errors.

    The rows are written once, and the prompts of both sides are asked for together.
    """
    own = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "prompts")
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_prompt").alias("prompt")) for s in SIDES])).alias("_s")
    asked = ask(own.select("_row", "judge", sides).select("_row", "judge", "_s.*"), "prompt", "judge", client, "raw", accept=accept, **how)
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}")
    wide = asked.groupBy("_row").agg(*[of(s, c) for s in SIDES for c in ("raw", "raw_error")])
    return own.join(wide, "_row").drop("_row", "ground_prompt", "structure_prompt")


def _told(samples: DataFrame, values: dict[str, Column], *more: str) -> DataFrame:
    """What the judges' prompts say of each sample, as a struct: worked out once a sample, not once a candidate."""
    return samples.select("sample_id", F.struct(*[values[k].alias(k) for k in TOLD]).alias("_told"), *more)


def judge_mean(candidates: DataFrame, samples: DataFrame, judge: str, client: Clients, **how) -> DataFrame:
    """Scores from 0 to 5 as means of checks; a judge that fails gives 0 and a note."""
    told = _told(samples, {"input": P.judge_input(), "history": P.judge_history(), "modules": P.module_sections()})
    own = candidates.join(told, "sample_id").withColumn("judge", F.lit(judge))
    values = {k: F.col(f"_told.{k}") for k in TOLD} | {"answer": F.col("response")}
    own = own.withColumns({"ground_prompt": P.render_once(GROUND_PROMPT, values), "structure_prompt": P.render_once(STRUCTURE_PROMPT, values)}).select("sample_id", "candidate_id", "model_type", "model_name", "judge", "ground_prompt", "structure_prompt", "_pos")
    own = ask_both(own, client, holds_checks(first_to_last_brace), **how)
    parse = reply_parser(first_to_last_brace)
    own = own.withColumns({f"_{side}": parse(f"{side}_raw") for side in SIDES})
    failed = F.col("_ground.checks").isNull() | F.col("_structure.checks").isNull()
    score = lambda side: F.when(failed, 0.0).otherwise(check_mean(F.col(f"_{side}.checks")))
    own = own.withColumns({"ground_score": score("ground"), "structure_score": score("structure"), "notes": F.when(failed, F.coalesce("ground_raw_error", "structure_raw_error", F.lit("a reply holds no JSON")))})
    return own.withColumn("aggregate_score", S.mean_score(F.col("ground_score"), F.col("structure_score"))).select("sample_id", "candidate_id", "model_type", "model_name", "judge", "ground_score", "structure_score", "aggregate_score", "notes", "ground_raw", "structure_raw", "_pos")


def dedup_penalties(penalties: Column) -> Column:
    """Of each rule the largest snapped score, the first of equal ones; in order of first appearance."""
    snapped = F.transform(penalties, lambda p: F.struct(F.upper(p["rule_id"]).alias("rule_id"), S.snap_penalty(p["score"]).alias("score"), p["reason"].alias("reason"), p["excerpt"].alias("excerpt")))
    # The first of the largest: later ones replace it only if they are larger.
    best = lambda held, r: F.aggregate(F.filter(held, lambda p: p["rule_id"] == r), F.lit(None).cast(f"struct<{PENALTY}>"), lambda a, p: F.when(a.isNull() | (p["score"] > a["score"]), p).otherwise(a))
    of_rules = lambda held: F.transform(F.array_distinct(F.transform(held, lambda p: p["rule_id"])), lambda r: best(held, r))
    # Bound, or else the findings are worked out anew for each rule.
    return bound(F.filter(snapped, lambda p: p["score"].isNotNull()), of_rules)


def score_penalties(judged: DataFrame, penalties: Column, confidence: Column, **parameters) -> DataFrame:
    """judged with penalties, total, dimension scores, label and weight. All of it stays within a row."""
    total = lambda rules=None: F.aggregate(F.filter("penalties", lambda p: p["rule_id"].isin(*rules)) if rules else F.col("penalties"), F.lit(0.0), lambda a, p: a + p["score"])
    out = judged.withColumns({"penalties": penalties, "confidence": confidence})
    out = out.withColumns({"total_score_20": S.total_score(total()), "ground_score": S.dimension_score(total(S.GROUND)), "structure_score": S.dimension_score(total(S.STRUCTURE))})
    threshold = parameters.get("threshold", S.THRESHOLD)
    return out.withColumns({"aggregate_score": S.aggregate_score(F.col("total_score_20")), "label": S.label(F.col("total_score_20"), threshold), "weight": S.weight(F.col("total_score_20"), F.col("confidence"), **parameters)})


def judge_deductions(candidates: DataFrame, samples: DataFrame, judge: str, client: Clients, repeat: int = 0, how: dict | None = None, **parameters) -> DataFrame:
    """Scores from 20 downwards, labels and weights; a candidate whose judge fails, or whose data has a score that cannot be graded, is dropped.

    ground_output and structure_output are the parsed replies (checks, confidence).
    """
    graded = samples.withColumn("_data", parse_data(F.col("data"))).filter(~F.coalesce(is_ungradable(F.col("_data")), F.lit(False)))
    user, history = P.deduction_inputs()
    told = _told(graded, {"input": user, "history": history, "modules": P.deduction_modules(F.when(F.col("_data").isNotNull(), F.col("data")))}, "_data")
    own = candidates.join(told, "sample_id").withColumn("judge", F.lit(judge))
    values = {k: F.col(f"_told.{k}") for k in TOLD} | {"answer": F.col("response")}
    own = own.withColumns({"ground_prompt": P.render_once(GROUND_PROMPT, values), "structure_prompt": P.render_once(STRUCTURE_PROMPT, values)})
    answer = text_or_empty("response")
    own = own.withColumns({"_valid": run_validators(answer, F.col("_data")), "_graded": is_graded(F.col("_data"))})
    own = own.select("sample_id", "candidate_id", "model_type", "model_name", "judge", "response", "ground_prompt", "structure_prompt", "_valid", "_graded", "_pos")
    own = ask_both(own, client, holds_checks(fenced_or_braced), run=repeat, **(how or {}))
    parse = reply_parser(fenced_or_braced)
    own = own.withColumns({f"_{side}": parse(f"{side}_raw") for side in SIDES})
    for side in SIDES:
        own = drop_failed(own, f"_{side}.checks")
    found = F.concat(F.coalesce("_valid", F.array().cast(PENALTIES)), checks_to_penalties(F.col("_ground.checks")), checks_to_penalties(F.col("_structure.checks")))
    confidence = average_confidence(*[S.normalize_confidence(F.col(f"_{side}.confidence")) for side in SIDES])
    scored = score_penalties(own, zero_penalty_guard(dedup_penalties(found), F.coalesce("response", F.lit("")), F.col("_graded")), confidence, **parameters)
    columns = ("sample_id", "candidate_id", "model_type", "model_name", "judge", "ground_score", "structure_score", "aggregate_score", "total_score_20", "label", "weight", "confidence", "penalties", "_pos")
    outputs = [F.col(f"_{side}").alias(f"{side}_output") for side in SIDES]
    return scored.select(*columns, *outputs, F.to_json("penalties").alias("penalties_json_20"), F.lit(repeat).alias("repeat_idx"))


def _two_answers(rows: DataFrame) -> DataFrame:
    """Rows of a two-answer table as texts, with the number of the row as sample_id."""
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns if c not in ("sample_id", "_source_row_index")]
    return rows.select(*texts, F.col("_source_row_index").cast("string").alias("sample_id"), "_source_row_index")


def judge_two_answers_run(rows: DataFrame, judge: str, client: Clients, repeat: int = 0, **how) -> DataFrame:
    """One run of a judge over a two-answer table: its judgements of both answers (model_name a and b) of every row whose
    answers could both be judged."""
    texts = _two_answers(rows)
    samples = samples_from(texts, F.col("_source_row_index"))
    sides = F.explode(F.array(*[F.struct(F.lit(x).alias("side"), F.col(f"answer_{x}").alias("response")) for x in "ab"])).alias("s")
    own = texts.select("sample_id", sides).select("sample_id", candidate_id(F.col("sample_id"), F.col("s.side")).alias("candidate_id"), F.lit("answer").alias("model_type"), F.col("s.side").alias("model_name"), "s.response", (F.col("s.side") == "b").cast("long").alias("_pos"))
    judged = judge_deductions(own, samples, judge, client, repeat, **how)
    return drop_failed_together(own.select("sample_id", "model_name").join(judged, ["sample_id", "model_name"], "left"), "sample_id", score="total_score_20")


def wide_two_answers(rows: DataFrame, judged: DataFrame, *by: str) -> DataFrame:
    """query, answer_a, answer_b and what the judgements (of one run, or aggregated over repeats) say of either, as columns
    ending in _a and _b; one row for each judged row of the table and each value of `by`."""
    columns = [c for c in ("n_repeats", "ground_score", "structure_score", "aggregate_score", "total_score_20", "total_score_20_list", "label", "label_mean", "weight", "confidence", "penalties_json_20") if c in judged.columns]
    of = lambda side, c: F.max(F.when(F.col("model_name") == side, F.col(c))).alias(f"{c}_{side}")
    wide = judged.groupBy("sample_id", *by).agg(*[of(side, c) for side in "ab" for c in columns])
    return _two_answers(rows).select("sample_id", "query", "answer_a", "answer_b").join(wide, "sample_id")


def judge_two_answers(rows: DataFrame, judge: str, client: Clients, **how) -> DataFrame:
    """Rows of a two-answer table (see scan_two_answers), one for each in which both answers could be judged: query, answer_a,
    answer_b and what the deduction scale says of either, as columns ending in _a and _b."""
    return wide_two_answers(rows, judge_two_answers_run(rows, judge, client, **how))


def build_pairs(scores: DataFrame, top_k: int = 1, bottom_k: int = 1, min_score_diff: float = 0.0, exclude_self: bool = False) -> DataFrame:
    return preference_pairs(rank_candidates(scores), top_k, bottom_k, min_score_diff, exclude_self)


def patch(raw: DataFrame, judged: DataFrame, source_file: str) -> DataFrame:
    """Raw rows of the samples whose candidates are all worth nothing."""
    return patch_rows(raw, all_zero_samples(manual_rank_rows(judged, source_file)))


def repaired_candidates(samples: DataFrame, models: DataFrame, candidates: DataFrame, client: Clients, **how) -> DataFrame:
    """The candidates of samples, those that were missing or placeholders generated anew; a call that fails again changes nothing."""
    plan = repair_plan(samples, models, candidates)
    wanted = prompts(samples).join(plan, "sample_id").join(F.broadcast(models), ["model_type", "model_name"])
    new = ask(wanted, "prompt", "model_name", client, "response", **how).filter("response is not null")
    new = new.select("sample_id", candidate_id(F.col("sample_id"), F.col("model_name")).alias("candidate_id"), "model_type", "model_name", "response", "gen_config", F.lit(0).cast("long").alias("_pos"))
    known = candidates.join(samples.select("sample_id"), "sample_id", "left_semi")
    return repair_apply(known, new.select(*candidates.columns)).select(*candidates.columns)


def with_contexts(samples: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row for each sample with its context, question and candidates."""
    contexts = samples.select("sample_id", P.context_text().alias("context"), F.col("query").alias("question"))
    return generated_rows(candidates, contexts, keep_empty=True)


def repair(samples: DataFrame, models: DataFrame, candidates: DataFrame, client: Clients, **how) -> DataFrame:
    """One row for each sample with its repaired candidates."""
    return with_contexts(samples, repaired_candidates(samples, models, candidates, client, **how))

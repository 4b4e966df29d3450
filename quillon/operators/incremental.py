"""What is left to do: resume, completion, repair and patch plans, and human scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.functions.scoring import manual_score
from quillon.operators.candidates import latest_per_key
from quillon.operators.masks import holds_all, missing, model_masks


def resume_pending(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """Candidates whose (sample_id, candidate_id) is not done yet; without an id they are pending."""
    return candidates.join(done.select("sample_id", "candidate_id").distinct(), ["sample_id", "candidate_id"], "left_anti")


def completed_samples(candidates: DataFrame, configured: DataFrame) -> DataFrame:
    """sample_id of samples that have a candidate of every configured (model_type, model_name)."""
    masks, models = model_masks(configured, candidates.select("sample_id", "model_type", "model_name"))
    return masks.filter(holds_all("have", models)).select("sample_id")


def to_generate(samples: DataFrame, completed: DataFrame) -> DataFrame:
    return samples.join(completed.select("sample_id"), "sample_id", "left_anti")


def incomplete_samples(samples: DataFrame, configured: DataFrame, candidates: DataFrame) -> DataFrame:
    """sample_id of samples that lack a candidate of some configured model."""
    masks, models = model_masks(configured, candidates.select("sample_id", "model_type", "model_name"), samples)
    return masks.filter(F.col("is_sample") & ~holds_all("have", models)).select("sample_id")


def repair_plan(samples: DataFrame, configured: DataFrame, candidates: DataFrame) -> DataFrame:
    """(sample_id, model_type, model_name) whose candidate is missing or a placeholder."""
    masks, models = model_masks(configured, candidates.select("sample_id", "model_type", "model_name", "response"), samples)
    return masks.filter("is_sample").select("sample_id", F.explode(missing("good", models)).alias("_m")).select("sample_id", "_m.model_type", "_m.model_name")


def repair_apply(candidates: DataFrame, new: DataFrame) -> DataFrame:
    """Candidates updated by new ones of the same (sample_id, model_type, model_name), with those appended that had none."""
    key = ["sample_id", "model_type", "model_name"]
    fresh = latest_per_key(new, *key, order="_pos").select(*key, F.struct(*[c for c in candidates.columns if c not in (*key, "_pos")]).alias("_new"), F.col("_pos").alias("_new_pos"))
    rest = [c for c in candidates.columns if c not in (*key, "_pos")]
    old = candidates.withColumn("_old", F.lit(True))
    both = old.join(fresh, key, "full_outer")
    return both.select(*key, *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in rest], F.coalesce("_pos", F.col("_new_pos") + (1 << 40)).alias("_pos"))


def drop_failed(judged: DataFrame, score: str = "total_score_20") -> DataFrame:
    """Candidates whose judgement did not fail, that is, gave a score."""
    return judged.filter(F.col(score).isNotNull())


def drop_failed_together(judged: DataFrame, *keys: str, score: str = "total_score_20") -> DataFrame:
    """Candidates of those groups (by keys) in which no judgement failed: of two answers, either both stay or none."""
    failed = F.count(F.when(F.col(score).isNull(), 1)).over(W.partitionBy(*keys))
    return judged.withColumn("_failed", failed).filter("_failed = 0").drop("_failed")


def all_zero_samples(manual: DataFrame) -> DataFrame:
    """sample_id of records whose manual scores are all 0 or less; what is no number counts as 0."""
    v = lambda x: F.coalesce(x["manual_score"].try_cast("double"), F.lit(0.0)) <= 0
    return manual.filter((F.size("manual_ranks") > 0) & F.forall("manual_ranks", v)).select("sample_id").distinct()


def patch_rows(raw: DataFrame, zero: DataFrame) -> DataFrame:
    return raw.join(zero.select("sample_id"), "sample_id", "left_semi")


def manual_rank_rows(judged: DataFrame, source_file: str) -> DataFrame:
    """Human-rank rows with scores derived from the totals; records without an item that has a candidate_id are left out."""
    ranks = F.transform(
        F.filter("results", lambda r: r["candidate_id"].isNotNull()),
        lambda r: F.struct(*[r[c].alias(c) for c in ("candidate_id", "model_name", "model_type", "aggregate_score", "ground_score", "structure_score")], manual_score(r["total_score_20"]).alias("manual_score")),
    )
    fields = [c for c in judged.columns if c != "results"]
    out = judged.filter("sample_id is not null").select("sample_id", F.lit(source_file).alias("source_file"), F.to_json(F.struct(*fields)).alias("context"), ranks.alias("manual_ranks"))
    return out.filter(F.size("manual_ranks") > 0)


def manual_upsert(existing: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Existing rows without those whose keys come anew, and the new rows."""
    return existing.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def with_manual_scores(results: DataFrame, saved: DataFrame, source_file: str) -> DataFrame:
    """Results with the last saved human score of their sample and candidate; what is no integer is skipped."""
    own = saved.filter(F.col("source_file") == source_file).withColumn("manual_score", F.col("manual_score").try_cast("int")).filter("manual_score is not null")
    last = latest_per_key(own, "sample_id", "candidate_id").select("sample_id", "candidate_id", "manual_score")
    return results.join(last, ["sample_id", "candidate_id"], "left")

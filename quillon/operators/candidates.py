"""Candidates of samples: nested and flat forms, latest and first rows, joins with samples and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.functions.text import filled
from quillon.operators.ordinals import with_ordinals


def latest_per_key(rows: DataFrame, *keys: str, order: str = "_ordinal") -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).filter("_r = 1").drop("_r")


def first_per_key(rows: DataFrame, *keys: str, order: str = "_ordinal") -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(order))).filter("_r = 1").drop("_r")


def group_by_sample(rows: DataFrame, name: str = "results") -> DataFrame:
    """sample_id and all its rows, without the key, in the order of _pos."""
    fields = [c for c in rows.columns if c not in ("sample_id", "_pos")]
    items = F.array_sort(F.collect_list(F.struct("_pos", *fields)))
    return rows.groupBy("sample_id").agg(F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in fields])).alias(name))


def flatten_grouped(grouped: DataFrame, name: str = "results") -> DataFrame:
    """Inverse of group_by_sample; a null or empty list gives no rows."""
    return grouped.select("sample_id", F.posexplode(name).alias("_pos", "_item")).select("sample_id", "_pos", "_item.*")


def flatten_candidates(generated: DataFrame) -> DataFrame:
    """One row a candidate; a null response is empty."""
    flat = flatten_grouped(generated, "candidates")
    return flat.withColumn("response", F.coalesce("response", F.lit("")))


def rehydrate_candidates(generated: DataFrame) -> DataFrame:
    """Candidates of the latest row of each sample (by _ordinal); rows without an id are left out."""
    return flatten_candidates(latest_per_key(generated.filter("sample_id is not null and sample_id <> ''"), "sample_id"))


def with_samples(candidates: DataFrame, samples: DataFrame) -> DataFrame:
    """Candidates with their sample's columns; candidates without a sample are dropped."""
    return candidates.join(samples, "sample_id")


def generated_rows(candidates: DataFrame, samples: DataFrame, keep_empty: bool = False) -> DataFrame:
    """sample_id, context, question, candidates; with keep_empty also samples that have none."""
    grouped = group_by_sample(candidates, "candidates")
    rows = samples.select("sample_id", F.coalesce("context", F.lit("")).alias("context"), "question").join(grouped, "sample_id", "left" if keep_empty else "inner")
    return rows.withColumn("candidates", F.coalesce("candidates", F.array().cast(grouped.schema["candidates"].dataType)))


def with_valid_text(scores: DataFrame, candidates: DataFrame) -> DataFrame:
    """Scores whose candidate has a response that is not blank."""
    texts = candidates.filter(filled("response")).select("sample_id", "candidate_id", "response")
    return scores.join(texts, ["sample_id", "candidate_id"])


def first_filled(*sources: DataFrame) -> DataFrame:
    """The rows of the first of these sources that has any. Whether an earlier one has is a subquery of the plan."""
    out = earlier = sources[0]
    for source in sources[1:]:
        out = out.unionByName(source.filter(~earlier.select(F.lit(1)).exists()))
        earlier = earlier.unionByName(source)
    return out


def response_index(*sources: DataFrame) -> DataFrame:
    """(sample_id, candidate_id, response) of the first source that holds a candidate's response: what lies beside the results
    comes first, and only where it holds none the next place."""
    return first_filled(*[s.filter("candidate_id is not null and response is not null").select("sample_id", "candidate_id", "response") for s in sources])


def with_context(scores: DataFrame, samples: DataFrame) -> DataFrame:
    """Scores with context and question where the sample is known."""
    return scores.join(samples.select("sample_id", "context", "question"), "sample_id", "left")


def tasks(left: DataFrame, configured: DataFrame) -> DataFrame:
    """Every row with every configured model. The configuration comes from a file, so its size does not follow the data."""
    return left.join(F.broadcast(configured))


def union_candidates(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def page(rows: DataFrame, first: int, n: int | None, order: str = "_ordinal") -> DataFrame:
    """Rows first to first + n - 1 by ordinal; None or 0 means all, a negative n none."""
    if n is None or n == 0:
        return rows.filter(F.col(order) >= first)
    return rows.filter((F.col(order) >= first) & (F.col(order) < first + max(n, 0)))


def of_sample(rows: DataFrame, sample_id: str) -> DataFrame:
    return rows.filter(F.col("sample_id").cast("string") == sample_id)


def long_form(wide: DataFrame, *keys: str) -> DataFrame:
    """Two rows, A and B, of a row with answer_a and answer_b."""
    return wide.unpivot(list(keys), ["answer_a", "answer_b"], "which", "answer").withColumn("which", F.upper(F.substring("which", -1, 1)))


def wide_form(long: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row a key with each column for A and for B."""
    pick = lambda c, w: F.max(F.when(F.col("which") == w.upper(), F.col(c))).alias(f"{c}_{w}")
    return long.groupBy(key).agg(*[pick(c, w) for w in "ab" for c in columns])


def sort_samples(rows: DataFrame, order: DataFrame) -> DataFrame:
    """Rows with _place, their number from 0 in the order (sample_id, _ordinal) of the input; samples that it lacks come last, by
    number, then by text."""
    known = latest_per_key(order, "sample_id").select("sample_id", F.col("_ordinal").alias("_at"))
    out = rows.join(known, "sample_id", "left").withColumns({"_no_at": F.col("_at").isNull(), "_number": F.col("sample_id").try_cast("long")})
    out = out.withColumn("_no_number", F.col("_number").isNull())
    # The keys hold no null but beside their flag, so ranges follow the order.
    return with_ordinals(out, "_no_at", "_at", "_no_number", "_number", "sample_id", name="_place").drop("_no_at", "_at", "_no_number", "_number")


def numbered_page(rows: DataFrame, first: int, n: int | None, *order: str) -> DataFrame:
    """Rows first to first + n - 1 of rows that have an order but no number yet."""
    return page(with_ordinals(rows, *order), first, n).drop("_ordinal")

"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

A source's target is min(cap, level * weight), where the cap is the source's size times the most epochs and the level is
the one at which the targets add up to the wanted total: sources are taken in ascending order of cap / weight, and those
whose ratio is below the level of the rest are clamped. A source's repetitions are whole epochs plus a fractional one. The
fractional epoch takes the documents in a seeded order (md5 of seed, doc_id and text, which spreads rows that share an id, or
have none) until its words are used up, so the words taken equal the target to the word; only the document at the end is
taken in part.

The seeded order is never built as one list: documents fall into 256 slices by the first two hex digits of the hash, slice
sums tell which slice the epoch ends in, the same is done within that slice by the next two digits, and only the 65,536th
part of a source that is left is ordered row by row.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source of its own, ordered last; sources of
size 0 have target 0; repeated rows are rows of their own; an empty table gives an empty result.
`mix` returns its own columns only; `mixed` returns the columns of its input, of which only text and n_chars of a document taken
in part change: its first words with the white space before them, and the length of that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.common import WORD, materialized, words_count

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
SHARE, MAX_EPOCHS, SEED = 1.5, 2, "mix-1"


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to these and target. One row a source: this small table is ordered as a whole."""
    every = W.partitionBy()
    rank = F.row_number().over(every.orderBy(F.col("source").isNull(), "source")) - 1
    own = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int")))
    own = own.withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    before = every.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(every) * F.lit(share)
    own = own.withColumn("_left", total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
    own = own.withColumn("_level", F.col("_left") / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    # The level of the first source that is not clamped holds for it and all after it.
    level = F.min(F.when(F.col("_level") * F.col("_w") < F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level").alias("v")))).over(every)["v"]
    target = F.least("_cap", F.coalesce(F.col("_at") * F.col("_w"), F.col("_cap")))
    own = own.withColumn("_at", level)
    return own.select("source", "source_size", F.round(target, 6).alias("target"))


def order_hash(seed: str = SEED):
    """The seeded order of documents, as text that any engine computes alike."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """For each row of docs: doc_id, source, size, source_size, target, and taken, the words that the mix takes of it."""
    small = materialized(docs.select("doc_id", "source", words_count(F.col("text")).alias("size"), order_hash(seed).alias("_h"), F.xxhash64("text").alias("_tie")), "mix-sizes")
    return _taken(small, small, weights, share, max_epochs).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: rows of docs as often as they are taken, the last document of a fractional epoch cut after its share of words."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id"), F.col("source"), words_count(F.col("text")).alias("size"), order_hash(seed).alias("_h"), F.xxhash64("text").alias("_tie"))
    small = materialized(own.drop("_row"), "mix-sizes")
    rows = _taken(own, small, weights, share, max_epochs).filter("taken > 0")
    rows = rows.withColumn("_copy", F.explode(F.expr("sequence(0L, (taken + size - 1) div size - 1)")))
    left = F.least(F.col("size"), F.col("taken") - F.col("_copy") * F.col("size"))
    # Each word of the share with the white space before it, so line breaks stay.
    words, gaps = F.regexp_extract_all(F.col("_row.text"), F.lit(WORD), F.lit(0)), F.split(F.col("_row.text"), WORD)
    cut = F.array_join(F.zip_with(F.slice(gaps, F.lit(1), left.cast("int")), F.slice(words, F.lit(1), left.cast("int")), lambda gap, word: F.concat(gap, word)), "")
    rows = rows.withColumn("_text", F.when(left == F.col("size"), F.col("_row.text")).otherwise(cut))
    own = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        n_chars = F.length("_text").cast(docs.schema["n_chars"].dataType)
        own["n_chars"] = F.when(left == F.col("size"), F.col("_row.n_chars")).otherwise(n_chars)
    return rows.select(*[own.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def _taken(rows: DataFrame, small: DataFrame, weights, share: float, max_epochs: int) -> DataFrame:
    """rows (with source, size, _h, _tie) with source_size, target and taken; small: these columns of the same rows, for the sums."""
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    rows, small = (x.withColumn("_key", key).withColumn("_a", F.substring("_h", 1, 2)).withColumn("_b", F.substring("_h", 3, 2)) for x in (rows, small))
    slices = small.groupBy("_key", "source", "_a").agg(F.sum("size").alias("_in"))
    aims = targets(slices.groupBy("source").agg(F.sum("_in").alias("source_size")), weights, share, max_epochs)
    aims = aims.withColumn("_key", key).withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")).cast("long")).otherwise(F.lit(0)))
    aims = materialized(aims.withColumn("_part", F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long")).drop("source"), "mix-targets")
    so_far = lambda by: F.coalesce(F.sum("_in").over(W.partitionBy("_key").orderBy(by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # The slice that the fractional epoch ends in with the words left for it, then the same within that slice.
    first = slices.join(aims, "_key").withColumn("_before", so_far("_a")).filter("_before < _part and _before + _in >= _part")
    first = materialized(first.select("_key", F.col("_a").alias("_end_a"), (F.col("_part") - F.col("_before")).alias("_left_a")), "mix-ends-a")
    inner = small.join(first, "_key").filter("_a = _end_a").groupBy("_key", "_left_a", "_b").agg(F.sum("size").alias("_in"))
    second = inner.withColumn("_before", so_far("_b")).filter("_before < _left_a and _before + _in >= _left_a")
    second = second.select("_key", F.col("_b").alias("_end_b"), (F.col("_left_a") - F.col("_before")).alias("_left_b"))
    rows = rows.join(materialized(aims.join(first.drop("_left_a"), "_key", "left").join(second, "_key", "left"), "mix-ends"), "_key")
    rows = rows.withColumn("_at_end", F.coalesce(F.expr("_a = _end_a and _b = _end_b"), F.lit(False)))
    last = rows.filter("_at_end").withColumn("_before", F.coalesce(F.sum("size").over(W.partitionBy("_key").orderBy("_h", "size", "_tie").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    last = last.withColumn("_extra", F.expr("greatest(0L, least(size, _left_b - _before))")).drop("_before")
    rest = rows.filter("not _at_end").withColumn("_extra", F.expr("case when _a < _end_a or (_a = _end_a and _b < _end_b) then size else 0L end"))
    return rest.unionByName(last).withColumn("taken", (F.col("_whole") * F.col("size") + F.col("_extra")).cast("long"))

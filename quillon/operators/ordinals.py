"""Ordinals and exact quantiles without a task that holds all rows: range partitions, their counts, and prefix sums."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.sources.shared import stored

#: monotonically_increasing_id() has the partition above so many bits, and the place within it below.
PLACE_BITS = 33


def with_ordinals(rows: DataFrame, *order: Column | str, name: str = "_ordinal") -> DataFrame:
    """rows with the number of rows before each in this order (a long from 0).

    Rows are dealt by ranges of the order, so each task sorts one range; a range's ordinals begin where those of the ranges
    before it end. Ties should be settled by the order: rows that it leaves equal are numbered as they come.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "ordinals")
    part = F.shiftright("_at", PLACE_BITS)
    # One row for each partition: small enough for the driver, whatever the rows.
    counts = sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for p, n in counts:
        before.append((p, total))
        total += n
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "_part long, _before long"))
    place = F.col("_at").bitwiseAND((1 << PLACE_BITS) - 1)
    return placed.join(offsets, part == F.col("_part")).select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + place).alias(name))


def running_counts(weighted: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """weighted with _before, the weights of the same keys with smaller values, and _total, all weights of the keys.

    Partitions are ranges of keys and value, so a key with very many values lies in many of them. Within a partition each key
    has a running sum; to it come the sums of the key in earlier partitions, of which there is one row for each partition.
    """
    dealt = weighted.repartitionByRange(*keys, value)
    placed = stored(dealt.withColumn("_part", F.spark_partition_id()), "ranges")
    within = W.partitionBy("_part", *keys).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = placed.groupBy("_part", *keys).agg(F.sum(weight).alias("_n"))
    parts = parts.select("_part", *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"), F.sum("_n").over(W.partitionBy(*keys)).alias("_total"))
    own = placed.withColumn("_within", F.coalesce(F.sum(weight).over(within), F.lit(0)))
    same = F.lit(True)
    for c in ("_part", *keys):
        same = same & own[c].eqNullSafe(parts[c])
    return own.join(parts, same).select(*[own[c] for c in weighted.columns], (F.col("_base") + F.col("_within")).alias("_before"), "_total")


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """keys and, by name, the exact quantiles of a number, interpolated between neighbours as percentile() does; nulls do not
    count, and keys without a value have null.

    Equal values are counted first, so that neither a frequent value nor a key of any number of rows meets in one task.
    """
    counted = rows.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_w"))
    held = running_counts(counted.filter("_v is not null"), keys, "_v", "_w")
    at = {q: (F.col("_total") - 1) * F.lit(p) for q, p in quantiles.items()}
    covers = lambda rank: (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_w"))
    # Two rows of a key for each quantile at most go on.
    held = held.filter(functools.reduce(Column.__or__, [covers(r(rank)) for rank in at.values() for r in (F.floor, F.ceil)]))
    out = []
    for q, rank in at.items():
        low, high = (F.max(F.when(covers(r), F.col("_v"))) for r in (F.floor(rank), F.ceil(rank)))
        share = F.max(rank - F.floor(rank))
        out.append(F.when(share > 0, low * (1 - share) + high * share).otherwise(low).alias(q))
    found = held.groupBy(*keys).agg(*out)
    empty = counted.groupBy(*keys).agg(F.bool_and(F.col("_v").isNull()).alias("_none")).filter("_none").drop("_none")
    return found.unionByName(empty, allowMissingColumns=True)

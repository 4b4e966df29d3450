"""Ordinals and quantiles by ranges: equal to windows and percentiles, and no task that holds a key."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.operators.ordinals import exact_quantiles, running_counts, with_ordinals


@pytest.fixture
def scores(spark):
    rng = random.Random(3)
    rows = [("hot", None, rng.gauss(0, 9)) for _ in range(4000)] + [("hot", "x", float(rng.randrange(3))) for _ in range(1500)]
    rows += [("one", "x", 5.0), ("none", "x", None), ("none", "x", None), (None, None, 1.0), (None, None, 2.0), ("some", "x", None), ("some", "x", 3.0), ("nan", "x", float("nan")), ("nan", "x", 1.0)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "model string, kind string, score double").repartition(7)


def test_ordinals_equal_row_numbers(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("b"))
    got = with_ordinals(rows.repartition(9), F.asc_nulls_last("b"), F.desc("a"), name="n")
    want = rows.withColumn("n", F.row_number().over(W.orderBy(F.asc_nulls_last("b"), F.desc("a"))) - 1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert with_ordinals(rows.filter("a < 0"), "a").count() == 0


def test_quantiles_equal_percentiles(scores):
    at = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "high": 1.0}
    for keys in (["model"], ["model", "kind"], []):
        got = exact_quantiles(scores.filter("model is null or model <> 'nan'"), keys, "score", at)
        own = scores.filter("model is null or model <> 'nan'")
        want = own.groupBy(*keys).agg(*[F.percentile("score", p).alias(q) for q, p in at.items()])
        plain = lambda df: sorted(([r[k] for k in keys] + [r[q] if r[q] is None else round(r[q], 9) for q in at] for r in df.collect()), key=repr)
        assert plain(got) == plain(want)
    nan = exact_quantiles(scores.filter("model = 'nan'"), ["model"], "score", {"low": 0.0, "high": 1.0}).first()
    assert nan.low == 1.0 and nan.high != nan.high


def test_a_hot_key_lies_in_many_partitions(spark, scores):
    """The values of one key are dealt over all ranges, and the rows that meet by key are few."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counted = scores.filter("score is not null").groupBy("model", "score").agg(F.count("*").alias("w"))
        placed = running_counts(counted, ["model"], "score", "w")
        each = [r["count"] for r in placed.filter("model = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        assert len(each) > 1 and max(each) < 0.9 * sum(each)
        want = scores.filter("score is not null").groupBy("model", "score").agg(F.count("*").alias("w"))
        prior = W.partitionBy("model").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
        want = want.select("model", "score", F.coalesce(F.sum("w").over(prior), F.lit(0)).alias("b"), F.sum("w").over(W.partitionBy("model")).alias("t"))
        assert sorted(map(repr, placed.select("model", "score", F.col("_before").alias("b"), F.col("_total").alias("t")).collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)

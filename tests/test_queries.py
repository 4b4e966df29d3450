"""Every query against the SQL that states the same, over the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__
from quillon import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows, columns):
    def value(x):
        if isinstance(x, bool) or x is None or isinstance(x, str):
            return x
        x = float(x)
        return None if math.isnan(x) else round(x, 5)

    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([value(r[i]) for i in at]) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    want = duck.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_repeats_itself(spark, name):
    got = queries.QUERIES[name](spark, SF)
    rows = sorted(map(repr, got.collect()))
    assert rows and rows == sorted(map(repr, queries.QUERIES[name](spark, SF).collect()))


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["sample_id", "positive", "negative"]


def test_filter_by_sample_reaches_the_scan(spark):
    """A filter on the partition column of a window is pushed below it and to the Parquet scan."""
    df = spark.read.parquet(f"{SF}/events.parquet")
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    ranked = df.withColumn("r", F.row_number().over(W.partitionBy("user_id").orderBy("value"))).filter("user_id = 8").select("event_id", "r")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,8)" in plan and "props" not in plan


def test_pairs_need_no_join(spark):
    plan = queries.QUERIES["pref_pairs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan

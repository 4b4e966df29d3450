"""Texts of one repeated thing: no rule may take long over them, and none may end the JVM."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import licenses, quality, topk

SIZE = 1_000_000


def runs():
    """A digit, a letter, a sign, a line break, a character outside of ASCII, and words of few letters, each over and over."""
    return ["7" * SIZE, "a" * SIZE, "#" * SIZE, "\n" * SIZE, "é" * SIZE, "1 " * (SIZE // 2), "a " * (SIZE // 2), "...\n" * (SIZE // 4), "- x\n" * (SIZE // 4)]


def seconds(df):
    began = time.perf_counter()
    rows = df.collect()
    return time.perf_counter() - began, rows


@pytest.mark.parametrize("rule", quality.RULES, ids=lambda r: r.name)
def test_quality_rules_on_runs(spark, rule):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(runs())], "doc_id long, text string").repartition(4)
    took, rows = seconds(quality.quality_rules(texts, (rule,)).select("doc_id", "failed_rule"))
    assert len(rows) == len(runs()) and took < 60


def test_rules_without_the_base_rule_on_runs(spark):
    """The cascade alone, as if no text failed the base rule."""
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(runs())], "doc_id long, text string").repartition(4)
    own = quality.with_features(quality.boxed(texts, "text"))
    took, rows = seconds(own.select(*[F.expr(r.rejects).alias(r.name) for r in quality.RULES]))
    assert len(rows) == len(runs()) and took < 60


def repeated_parts():
    """Each rule's own words and whatever of its pattern may repeat, over and over."""
    for rule in licenses.signatures():
        plain = re.sub(r"\(\?[:=!]|[()?*+|]|\{[0-9,]+\}|\\S|\[[^]]*\]", " ", rule.pattern)
        yield " ".join((plain + " 2001 ").split())
    yield from ("copyright 2001", "2001", "copyright", "x", "not", "licensed under the terms of the")


def test_license_rules_on_their_own_words(spark):
    """Years 200,000 times behind a notice, and every rule's words many times in one text of 100,000 characters."""
    texts = ["copyright " + "2001 " * 200_000, "copyright 2001 " * 60_000, "7" * SIZE, "a" * SIZE, "neither the name of " + "x" * SIZE, "neither the name of " + "x " * (SIZE // 2)]
    parts = sorted(set(repeated_parts()))
    texts += [(p + " ") * (100_000 // (len(p) + 1) + 1) for p in parts[:: max(1, len(parts) // 60)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    took, rows = seconds(licenses.scan_licenses(df).select("doc_id", "labels", "n_words", F.try_element_at("hits", F.lit(1))["words"].alias("first")))
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(texts) and took < 200
    assert got[0].labels == "copyright" and got[0].first == 200_001


def test_every_rule_survives_years(spark):
    """Each pattern by itself over 100,000 repetitions of what its unbounded group takes."""
    text = " copyright" + " 2001" * 100_000 + " "
    rules = [r for r in licenses.signatures() if re.search(r"\)[*+]|\{[0-9]+,\}", r.pattern)]
    assert [r.label for r in rules] == ["copyright"]
    one = spark.createDataFrame([(text,)], "t string")
    found = one.select(*[F.length(F.regexp_extract("t", f" (?:{r.pattern})(?= )", 0)).alias("n") for r in rules]).first()
    assert found.n == len(text) - 1
    # A year that is no word of its own ends the run, as it did.
    assert spark.createDataFrame([(" copyright 2001 2002 20034 ",)], "t string").select(F.regexp_extract("t", f" (?:{rules[0].pattern})(?= )", 0)).first()[0] == " copyright 2001 2002"


def test_top_k_of_huge_components(spark):
    """Scores of hundreds of digits rank like any other, and a score beyond a long is null."""
    vectors = [(0, [1e20, 1.0]), (1, [1e20, -1.0]), (2, [-1e300, 0.0]), (3, [1e300, 5.0]), (4, [0.5, 0.5]), (50, [2.0, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors}
    for q in (0, 50):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:5]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [(int(r.exact), r.vec_id) for r in own] == [(-s, i) for s, i in best]
        assert all(r.score == (int(r.exact) if abs(int(r.exact)) < 2**63 else None) for r in own)

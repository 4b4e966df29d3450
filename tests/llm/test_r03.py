"""What a third review found in the corpus operators."""

import random

import numpy as np
from pyspark.sql import functions as F

from quillon.llm import bpe, neardup, tokenfile
from quillon.llm.components import components

from .conftest import prose
from .test_operators import library


def test_sets_of_one_group_make_about_one_edge_each(spark):
    """Sets that meet in 32 bands at lows of their own are tied once; what is connected stays so."""
    rng = random.Random(4)
    pairs = {(n, rng.randrange(n // 1000 * 1000, n // 1000 * 1000 + 60)) for n in range(3000) for _ in range(32)}
    met = spark.createDataFrame([*pairs, *((low, low) for _, low in pairs)], "node long, low long").distinct()
    edges = neardup.star_edges(met)
    assert edges.count() < 2 * 3000
    plain = met.filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    assert sorted(components(edges, "x").collect()) == sorted(components(plain, "y").collect())


def test_the_library_sees_each_unit_once(monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, 300) + " it's　DON'T <|endoftext|>\n" for _ in range(40)] + ["", "é" * 50]
    seen = []
    whole = tokenfile.library_ids
    monkeypatch.setattr(tokenfile, "library_ids", lambda path, x, batch: seen.extend(x) or whole(path, x, batch))
    tokenfile.library_units.cache_clear()
    units = tokenfile.library_units(bpe.vocabulary_path())
    for part in (texts[:20], texts[20:], texts):
        ids, counts = units([t.encode() for t in part])
        ends = np.cumsum(counts)
        assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [library().encode(x, add_special_tokens=False).ids for x in part]
    assert len(seen) == len(set(seen)) < 1000
    tokenfile.library_units.cache_clear()

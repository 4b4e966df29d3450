"""What a worker remembers of units changes no result."""

import random

import numpy as np

from quillon.llm import bpe, tokenfile

from .test_operators import library


def test_forgetting_keeps_results():
    rng = random.Random(1)
    tk = library()
    coder, _ = bpe.codec(bpe.vocabulary_path())
    units = bpe.Units(coder.encode_units, most=60)
    sizes = []
    for _ in range(40):
        texts = [" ".join(f"w{min(rng.randrange(300), rng.randrange(300))}" for _ in range(30)) + rng.choice(["", "\n x", "  y"]) for _ in range(3)]
        ids, counts = units([x.encode() for x in texts])
        ends = np.cumsum(counts)
        assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [tk.encode(x, add_special_tokens=False).ids for x in texts]
        sizes.append(units.keys.size)
    assert max(sizes) < 200 and units.uses.size == units.starts.size == units.counts.size == units.checks.size == units.keys.size == units.places.size == units.sizes.size
    units([b"x" * 5000])
    assert units([b"a b"])[1].tolist() == [2]


def test_long_texts_are_cut_at_units(monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 40)
    tk = library()
    coder, _ = bpe.codec(bpe.vocabulary_path())
    units = bpe.Units(coder.encode_units)
    texts = ["word 12  two\n three, " * 30, "", "x" * 300, "é ü " * 50, "short"]
    ids, counts = units([x.encode() for x in texts])
    ends = np.cumsum(counts)
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [tk.encode(x, add_special_tokens=False).ids for x in texts]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_units_of_equal_polynomial_hash_keep_their_own_ids(spark):
    one = "xxxxxxx" + thue_morse(1024)
    texts = [one, "xxxxxxx" + thue_morse(1024).translate(str.maketrans("ab", "ba")), "a " + one, one]
    tk = library()
    coder, _ = bpe.codec(bpe.vocabulary_path())
    units = bpe.Units(coder.encode_units)
    data = np.frombuffer("".join(texts[:2]).encode(), np.uint8)
    keys, checks = units.hashes(data, np.array([0, 1031]), np.array([1031, 2062]))
    assert keys[0] == keys[1] and checks[0] == checks[1]
    for group in (texts, texts[::-1], texts[:1], texts[1:2]):
        ids, counts = units([x.encode() for x in group])
        ends = np.cumsum(counts)
        assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [tk.encode(x, add_special_tokens=False).ids for x in group]
        assert coder.decode(ids.astype(np.int64), counts) == group
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert all(r.decoded == r.text for r in bpe.round_trip(docs).collect())
    back = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in tokenfile.read_tokens(spark, *tokenfile.write_tokens(docs)).collect()}
    assert back == {i: tk.encode(x, add_special_tokens=False).ids + [2] for i, x in enumerate(texts)}

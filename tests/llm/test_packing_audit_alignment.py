"""Operators 11 to 13 against brute force: packing, filter audit, alignment of two tokenizers."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon.llm import alignment, audit, packing
from quillon.llm.bpe import vocabulary_path


def whole_tokenizer(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


ODD = ["<|endoftext|> a<|startoftext|>b <|", "é ́x ΑΣ ΣΑΣ. İ ǅ", "DON'T we'Ll\x1cx\x85y　z\xa0w", "\x00\x0b\x0c a\r\nb", "日本語 テキスト", "🙂" * 30, "ﬁ ２ Ⅷ ½", "", "   "]


# --- 11: packing

#: Letters in both cases with marks that compose in one case only, letters whose lower case is two characters, special tokens in capitals, new letters.
CASES = ["J\u030c j\u030c I\u0307 i\u0307 W\u030a H\u0331 T\u0308", "İstanbul ǅ ẞ ŉ \u212a \u212b", "<|ENDOFTEXT|> <|EndOfText|>x", "ΑΣ ΣΑΣ ΌΣΟΣ", "\u1c89 \ua7cb \U00010d50 \U0001e5d0 ꟲ ᲀ", "école ÉCOLE e\u0301cole DON'T It'S 'S", "한글 \u1112\u1161\u11ab \u0e01\u0e33"]


def test_words_give_the_ids_of_whole_texts():
    words, tokenizer = packing.Words(vocabulary_path("word_bpe_49k.json"), most=40), whole_tokenizer("word_bpe_49k.json")
    rng = random.Random(1)
    texts = ODD + CASES + [" ".join(rng.choice(ODD + CASES + ["the", "of", "zqxj" + str(i)]) for i in range(rng.randrange(90))) for _ in range(30)] + ["a" * 50000]
    for part in (texts[:10], texts[10:], texts):
        ids, counts = words([t.encode() for t in part])
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in part]
        assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == [len(x) for x in want]


def tightest_first(sizes, window):
    """Best-fit decreasing by looking at every window; of equal ones the last put there."""
    out, room = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in room if r >= sizes[i]]
        if fits:
            w = max((w for w, r in enumerate(room) if r == min(fits)), key=lambda w: out[w][-1][1])
            room[w] -= sizes[i]
        else:
            out.append([])
            room.append(window - sizes[i])
            w = len(out) - 1
        out[w].append((i, sum(map(len, out))))
    return [[i for i, _ in w] for w in out]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w), max_size=60))))
def test_best_fit_takes_the_tightest_window(case):
    window, sizes = case
    assert packing.best_fit(sizes, window) == tightest_first(sizes, window)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 300), st.lists(st.integers(1, 200), max_size=40))
def test_packer_keeps_every_id_once_and_pads_nothing(window, pool, counts):
    packer, got = packing.Packer(window, pool, 0), []
    for i, n in enumerate(counts):
        packer.add(i, np.arange(n, dtype=np.uint32) + 1000 * i)
        got.append(packer.take(last=False))
    got.append(packer.take(last=True))
    rows = [r for b in got if b is not None for r in b.to_pylist()]
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, n in enumerate(counts):
        own = sorted(by_doc[i], key=lambda r: r["start"])
        assert [r["start"] for r in own] == list(itertools.accumulate([0, *(r["length"] for r in own[:-1])]))
        assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist() == [1000 * i + k for k in range(n)]
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        ends = list(itertools.accumulate(r["length"] for r in own))
        assert [r["offset"] for r in own] == [0, *ends[:-1]]
        assert ends[-1] == window or ends[-1] & (ends[-1] - 1) == 0 and ends[-1] < window


def test_pack_sequences(spark, docs, rows, empty):
    tokenizer = whole_tokenizer("word_bpe_49k.json")
    got = packing.pack_sequences(docs, window=64, pool=2000).collect()
    want = collections.Counter((i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t, *_ in rows)
    single = [r for r in got if r.doc_id is not None and r.doc_id != 96]
    found = collections.defaultdict(dict)
    for r in single:
        found[r.doc_id][r.start] = bytes(r.ids)
        assert r.length * 4 == len(r.ids)
    assert {(i, b"".join(v for _, v in sorted(x.items()))) for i, x in found.items()} == {k for k in want if k[0] is not None and k[0] != 96}
    # Rows of no id, or of one id twice, are documents of their own.
    assert sum(r.length for r in got) == sum(len(ids) // 4 * n for (_, ids), n in want.items())
    assert all(r.doc_tokens * 4 in {len(ids) for i, ids in want if i == r.doc_id} for r in got)
    sizes = collections.Counter()
    for r in got:
        sizes[r.sequence_id] += r.length
    assert all(n == 64 or n & (n - 1) == 0 for n in sizes.values())
    assert packing.pack_sequences(empty).count() == 0
    with pytest.raises(ValueError, match="a token at least"):
        packing.Packer(0, 1, 0)


# --- 12: filter audit


def slow_audit(rows, labels):
    import re

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    facts = []
    for i, text, _, source, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        fails["E"] = i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows)
        facts.append((source or "", {x for x, f in fails.items() if f}, i in good, i in toxic))
    for part in {f[0] for f in facts}:
        own = [f for f in facts if f[0] == part]
        made, shapley = [], collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = own
            for step, letter in enumerate(order, 1):
                gone = [f for f in alive if letter in f[1]]
                alive = [f for f in alive if letter not in f[1]]
                shapley[letter] += len(gone)
                made.append((part, order, step, len(alive), len(gone), sum(letter in f[1] for f in own) - len(gone), sum(f[1] == {letter} for f in own), sum(f[2] for f in gone), sum(f[3] for f in gone)))
        yield from ((*m, shapley[m[1][m[2] - 1]]) for m in made)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("chunk", [audit.CHUNK_ROWS, 7])
def test_audit_equals_counting(spark, docs, rows, monkeypatch, chunk):
    monkeypatch.setattr(audit, "CHUNK_ROWS", chunk)
    labels = [(i, i % 3 % 2, i % 7 // 5) for i in range(0, 97, 2)] + [(4, 0, 1), (4, None, None), (None, 1, 1), (1000, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [tuple(r[c] for c in AUDIT) for r in audit.audit_filters(docs, table).collect()]
    assert sorted(got) == sorted(slow_audit(rows, labels))


def test_audit_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_filters(empty, none).count() == 0
    assert {(r.good_lost, r.toxic_lost) for r in audit.audit_filters(docs, none).collect()} == {(0, 0)}


def test_audit_takes_other_filters(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = audit.audit_filters(docs, none, {"X": F.length("text") == 0}).filter("filter_order = 'XE'").groupBy("step").agg(F.sum("removed").alias("n")).collect()
    blank = sum(not t for _, t, *_ in rows)
    assert {r.step: r.n for r in got}[1] == blank


@pytest.mark.parametrize("n_parts", [1, 5, 200])
def test_bitmaps_of_many_parts(n_parts):
    rng = np.random.default_rng(n_parts)
    n = 1000
    part = np.unique(rng.integers(0, n_parts, n), return_inverse=True)[1]
    fails, good, toxic = [rng.random(n) < 0.4 for _ in range(3)], rng.random(n) < 0.5, rng.random(n) < 0.1
    found = audit.prefix_counts(part, fails, good, toxic)
    for p, before, f, *counts in zip(*(found[c].tolist() for c in ("part", "before", "filter", *audit.COUNTS))):
        alive = (part == p) & ~np.any([fails[i] for i in range(3) if before >> i & 1] or [np.zeros(n, bool)], axis=0)
        gone = alive & fails[f]
        assert counts == [alive.sum(), gone.sum(), (gone & good).sum(), (gone & toxic).sum()]


# --- 13: alignment


def token_bytes():
    """Encoders of both sides by the libraries: a text's ids and their bytes."""
    import sentencepiece

    a = whole_tokenizer("byte_bpe_50k.json")
    a.encode_special_tokens = True
    spare, own = itertools.count(256), [*range(33, 127), *range(161, 173), *range(174, 256)]
    value = {chr(b) if b in own else chr(next(spare)): b for b in range(256)}
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return lambda t: [(i, bytes(value[c] for c in a.id_to_token(i))) for i in a.encode(t, add_special_tokens=False).ids], lambda t: [(i, piece(i)) for i in b.encode(t)]


def slow_alignment(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by plain loops."""
    encode_a, encode_b = token_bytes()
    each, count = [], collections.Counter()
    for i, text, *_ in rows:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        if any(b"".join(x for _, x in s) != (" " + (text or "")).encode() for s in (a, b)):
            each.append((i, 0, 0, [], []))
            continue
        ends_a, ends_b = (list(itertools.accumulate(len(x) for _, x in s)) for s in (a, b))
        groups, at_a, at_b = [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(([x for x, _ in a[at_a:to_a]], [x for x, _ in b[at_b:to_b]]))
            at_a, at_b = to_a, to_b
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        count.update(set(links))
        each.append((i, len(a), len(b), groups, links))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    for i, na, nb, groups, links in each:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield i, na, nb, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), text


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
PLAIN = ["▁ is taken for a space", "<s> </s> <unk> <0x41> <|endoftext|>", "  two  spaces ", " \n\t\r\n ", "a" * 3000, " " * 500, "０１２ ｆｕｌｌ", "0" * 777, "日本語" * 50, "नमस्ते " * 20]


@pytest.mark.parametrize(("links", "block"), [(alignment.CHUNK_LINKS, alignment.BLOCK), (40, 16)])
def test_alignment_equals_loops(spark, docs, rows, monkeypatch, links, block):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", links)
    monkeypatch.setattr(alignment, "BLOCK", block)
    more = [(200 + i, t) for i, t in enumerate(PLAIN + [x for x in ODD if x])]
    # A text of 20,000 equal letters has links beyond what plain loops finish soon; it is told from PLAIN's shorter one.
    own = docs.filter("doc_id is null or doc_id <> 94").select("doc_id", "text", "source", "n_words", "_t").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = [tuple(r[c] for c in ALIGNED) for r in alignment.align(own).collect()]
    want = list(slow_alignment([r[:2] for r in rows if r[0] != 94] + more))
    assert collections.Counter(got) == collections.Counter(want)
    assert [r[1] for r in want if r[0] == 200] == [0] and all(r[1] for r in want if r[0] in (201, 202, 204))


def test_alignment_of_empty_and_of_texts_without_tokens(spark, empty):
    assert alignment.align(empty).count() == 0
    got = alignment.align(spark.createDataFrame([(1, None), (2, ""), (None, "▁")], "doc_id long, text string"), groups=F.sha2("groups", 256)).collect()
    assert {(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) for r in got} == {(i, 0, 0, 0, 0, 0, 0) for i in (1, 2, None)}
    assert {r.groups for r in got} == {hashlib.sha256(b"").hexdigest()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 3)), max_size=60), st.integers(1, 9))
def test_links_in_blocks(tokens, block):
    """Groups of random tokens, expanded few links at a time, and all at once."""
    groups = sorted({g for g, _, _ in tokens})
    at = {g: i for i, g in enumerate(groups)}
    a = sorted((at[g], x) for g, x, _ in tokens)
    b = sorted((at[g], y) for g, _, y in tokens)
    docs = np.arange(len(groups)) // 2
    want = collections.Counter((docs[g], x, y) for g, x in a for h, y in b if g == h)
    column = lambda s, i: np.array([x[i] for x in s], np.int64)
    before, alignment.BLOCK = alignment.BLOCK, block
    try:
        keys, times = alignment.linked(column(a, 1), column(a, 0), column(b, 1), column(b, 0), docs, 4, 4)
    finally:
        alignment.BLOCK = before
    assert {(k // 16, k // 4 % 4, k % 4): t for k, t in zip(keys.tolist(), times.tolist())} == dict(want)


def test_digests_of_the_queries(spark):
    """Columns of the contracts are derived from the operators' texts and ids."""
    sf = "/root/testdata/sf0.001"
    from quillon.llm import queries

    row = queries.op11_packing(spark, sf).orderBy("sequence_id", "offset").first()
    piece = packing.pack_sequences(spark.read.parquet(f"{sf}/documents.parquet")).orderBy("sequence_id", "offset").first()
    assert row.ids_crc32 == zlib.crc32(bytes(piece.ids)) and row.length == piece.length
    got = {r.doc_id: r.groups_sha256 for r in queries.op13_alignment(spark, sf).collect()}
    texts = alignment.align_texts(alignment.aligner(vocabulary_path(), vocabulary_path("piece_bpe_32k.model")), [b"the word"])
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and texts["groups"][0].count(";") + 1 == texts["n_groups"][0]
    assert pa.types.is_string(pa.array(list(got.values())).type)

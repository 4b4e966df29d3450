import collections
import io
import os
import re
import uuid
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quillon.llm import bpe, langid, licenses, mixing, quality, simhash, substring, tokenfile, topk, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
os.environ["TOKENIZERS_PARALLELISM"] = "false"


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


def same(a, b):
    assert collections.Counter(map(repr, a)) == collections.Counter(map(repr, b))


# --- 1: language ID


def test_language_id_learns_and_defines_edges(spark, docs, empty):
    english, german = "the thing that was with them and ", "der die und nicht ein mit schon "
    train = spark.createDataFrame([(i, (english if i % 2 else german) * (1 + i % 9), "en" if i % 2 else "de") for i in range(200)], "doc_id long, text string, lang string")
    network = langid.fit(train)
    assert network.languages == ["de", "en"]
    asked = spark.createDataFrame([(1, english), (2, german * 300), (3, None), (4, ""), (5, "12 !?"), (None, english)], "doc_id long, text string")
    got = langid.identify(asked, network).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und", "und", "en"]
    assert [r.score == 0 for r in got] == [False, False, True, True, True, False] and all(0 <= r.score <= 1 for r in got)
    assert langid.identify(docs, network).count() == docs.count()
    assert langid.fit(empty).languages == [] and langid.identify(empty, network).count() == 0
    assert {r.lang_pred for r in langid.identify(asked, langid.fit(empty)).collect()} == {"und"}


def test_held_out_is_never_trained_on(spark):
    df = spark.createDataFrame([(i,) for i in range(500)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.h for r in df.withColumn("h", langid.held_out()).collect()}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got.items())
    only = spark.createDataFrame([(i, "text", "xx") for i, h in got.items() if h], "doc_id long, text string, lang string")
    assert langid.fit(only).languages == []


def test_lookup_inference_equals_convolution():
    rng = np.random.default_rng(0)
    network = langid.train(rng.integers(0, 256, (64, langid.WINDOW), dtype=np.uint8), rng.integers(0, 3, 64), ["a", "b", "c"], epochs=1)
    windows = rng.integers(0, 256, (5, langid.WINDOW), dtype=np.uint8)
    e = network.embedding[windows]
    pooled = np.concatenate([np.concatenate([e[:, j : langid.WINDOW - n + 1 + j] for j in range(n)], axis=2).__matmul__(w).max(axis=1) for n, w in zip(langid.WIDTHS, network.filters)], axis=1)
    logits = np.maximum(pooled + network.bias, 0) @ network.out + network.out_bias
    expected = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    assert np.allclose(langid.Classifier(network).log_probabilities(windows), expected, atol=1e-4)


# --- 2 and 5: token files, BPE


def test_bpe_equals_library(docs, empty):
    tk = library()
    for r in bpe.round_trip(docs).collect():
        ids = tk.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded == tk.decode(ids, skip_special_tokens=False) == (r.text or "")
    assert bpe.round_trip(empty).count() == 0
    assert bpe.decode(bpe.encode(docs)).filter("decoded <> ifnull(text, '')").count() == 0


def test_decode_of_broken_bytes(spark):
    tk = library()
    ids = tk.encode("日本", add_special_tokens=False).ids[:-1]
    df = spark.createDataFrame([(bytearray(np.array(ids, "<u4").tobytes()),), (None,)], "ids binary")
    assert [r.decoded for r in bpe.decode(df).collect()] == [tk.decode(ids, skip_special_tokens=False), ""]


def test_token_files_round_trip(spark, docs, rows, empty):
    tk, start, expected = library(), 0, []
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tk.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    folder, files = tokenfile.write_tokens(docs)
    same([(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in tokenfile.read_tokens(spark, folder, files).collect()], expected)
    assert tokenfile.read_tokens(spark, *tokenfile.write_tokens(empty)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_simple8b_words(n):
    rng = np.random.default_rng(n)
    values = (rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) >> rng.integers(0, 64, n).astype(np.uint64)
    words, sizes = tokenfile.pack(values)
    n_ids = np.minimum(tokenfile.BLOCK, n - np.arange(len(sizes)) * tokenfile.BLOCK)
    assert (tokenfile.unpack(words, sizes, n_ids) == values).all()


# --- 3: top k


def best_rows(data, scale=256, k=5):
    """The ranking of every query row among all other rows, in whole numbers."""
    own = [(i, [int(np.floor(scale * np.float64(x))) for x in v]) for i, v in data if i is not None and v and all(x is not None and np.isfinite(x) and np.isfinite(scale * np.float64(x)) for x in v)]
    for a, (q, x) in enumerate(own):
        if q % 50 == 0:
            best = sorted((-sum(s * t for s, t in zip(x, y)), i) for b, (i, y) in enumerate(own) if a != b)[:k]
            yield from ((q, r + 1, i, -s) for r, (s, i) in enumerate(best))


def test_top_k_equals_brute_force(spark):
    asked = F.col("vec_id") % 50 == 0
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(0, 1, 12).astype(np.float32).tolist()) for i in range(700)] + [(1000 + i, [0.5] * 12) for i in range(300)]
    data += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 12), (2150, [float("inf")] * 12), (None, [1.0] * 12), (2200, []), (2250, [0.0] * 12), (2300, [3.0])]
    data += data[:3] + [data[0], (50, [0.25] * 12), (50, [-0.25] * 12)]  # repeated rows, and several vectors of one id
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<float>, score string, copies int")
    same([(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, asked).collect()], list(best_rows(data)))
    assert topk.top_k(df.limit(0), asked).count() == 0
    two = df.filter("vec_id in (1, 2, 50)").limit(2)
    assert topk.top_k(two, asked).count() <= 2


def test_top_k_of_large_components(spark):
    data = [(0, [1.0, 1.0]), (1, [1.8e7, 0.0]), (2, [1e7, 1e7]), (3, [-1e12, 1.0]), (50, [3e15, 3e15]), (100, [1e7, 1e-3])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    want = list(best_rows(data))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    same([(r.query_id, r["rank"], r.vec_id, int(r.exact)) for r in got], want)
    assert all(r.score == (int(r.exact) if abs(int(r.exact)) < 2**63 else None) for r in got) and any(r.score is None for r in got)
    assert (0, 3, 1, 1_179_648_000_000) in want


def test_lists_are_read_in_part_where_values_are_skewed():
    rng = np.random.default_rng(8)
    values = np.floor(256 * rng.pareto(1.5, (2000, 16)))
    block = topk.Block(np.arange(2000), values, np.ones(2000, np.int64))
    for i in range(20):
        query = np.zeros(16)
        query[rng.choice(16, 3, replace=False)] = rng.integers(1, 300, 3) * rng.choice([1, 1, -1])
        ids, scores = block.best(query, 5, np.arange(2000) == i)
        want = sorted((-int(s), j) for j, s in enumerate(values @ query) if j != i)[:5]
        assert [(-s, j) for s, j in zip(scores, ids)] == want
    assert block.reads < 0.5 * 20 * 3 * 2000


# --- 4: substring dedup


def removed(rows):
    first = {}
    big = 1 << 62
    words = [WORD.findall(t or "") for _, t, *_ in rows]
    for (i, *_), w in zip(rows, words):
        for p in range(len(w) - 12):
            key = tuple(w[p : p + 13])
            first[key] = min(first.get(key, big + 1), big if i is None else i)
    for (i, *_), w in zip(rows, words):
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < (big if i is None else i) for q in range(p, p + 13)}
        yield i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)


def test_substring_dedup_equals_brute_force(docs, rows, empty):
    got = substring.drop_duplicate_spans(docs)
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()], list(removed(rows)))
    assert "n_removed" in got.columns and substring.drop_duplicate_spans(empty).count() == 0


def by_column(tables, column):
    """What a shuffle does: rows of all these tables by the values of a column."""
    whole = pa.concat_tables(tables)
    keys = whole.column(column).to_pylist()
    return {k: whole.take([i for i, x in enumerate(keys) if x == k]) for k in set(keys)}


def parsed_in_process(rows, blocks, groups, chunk):
    """The stages of substring dedup without a session."""
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], substring.TAG: pa.array([xxhash.xxh32_intdigest(r[1] or "") for r in rows], pa.int64())})
    sent = [pa.Table.from_batches([b]) for i in range(0, len(rows), chunk) for b in substring.sent_pieces(iter(table.slice(i, chunk).combine_chunks().to_batches()), blocks, groups)]
    known = by_column([substring.shared_pieces(x, groups) for x in by_column(sent, "cell").values()], "grp")
    ids = np.array([substring.NO_ID if r[0] is None else r[0] for r in rows], np.int64)
    group = substring.group_of(ids, table.column(substring.TAG).to_numpy(), groups)
    dealt = {g: table.take(np.flatnonzero(group == g)) for g in range(groups)}
    empty = pa.table({"grp": pa.array([], pa.int64()), "kind": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})
    words = by_column([substring.sent_words(dealt[g], known.get(g, empty), blocks, groups) for g in dealt], "cell")
    found = [substring.factored_block(x, groups) for x in words.values()]
    spans = by_column([x.filter(pa.compute.equal(x.column("kind"), substring.DUPLICATE)) for x in known.values()] + found + [empty], "grp")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
    out = [substring.cleaned(dealt[g], spans.get(g, empty), schema) for g in dealt]
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for t in out for r in t.to_pylist()], max(len(x) for x in words.values())


@pytest.mark.parametrize("hot", [(64, 20_000), (2, 20_000), (64, 3), (1, 1)])
def test_hot_anchors_are_split_without_loss(monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_IN_CHUNK", hot[0])
    monkeypatch.setattr(substring, "HOT_IN_BLOCK", hot[1])
    rng = np.random.default_rng(6)
    phrase, passage = "to be or not to be that is the question", " ".join(f"p{i}" for i in range(40))
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 60, n))
    rows = [(i, f"{word(rng.integers(0, 9))} {phrase} {word(rng.integers(0, 9))} {passage if i % 3 == 0 else ''} {word(rng.integers(0, 5))} {phrase}") for i in rng.permutation(300).tolist()]
    rows += [(rows[5][0], rows[5][1]), (None, rows[6][1]), (None, rows[6][1]), (7, rows[8][1]), (400, None), (401, "few words")]
    got, _ = parsed_in_process(rows, 5, 7, 60)
    same(got, list(removed(rows)))


def test_pieces_of_equal_hash_are_told_apart_by_their_words(monkeypatch):
    monkeypatch.setattr(substring, "gram_hashes", lambda codes, n: np.full(len(codes), 3, np.uint64))
    monkeypatch.setattr(substring, "mixed", lambda x: x * np.uint64(0) + np.uint64(9))
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3, 16))) for i in range(6)] + [(9, "a b c d e f g h i j k l m n"), (10, "a b c d e f g h i j k l m n")]
    got, _ = parsed_in_process(rows, 2, 3, 4)
    want = list(removed(rows))
    # Windows of equal hash may hide a source from the index, but no word goes whose window is not in a smaller document.
    assert all(a[2] <= b[2] for a, b in zip(sorted(got), sorted(want)))


def test_factors_on_small_alphabets():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = rng.integers(13, 40, 12)
        texts = [rng.integers(0, 2, n).astype(np.uint64) + np.uint64(5) for n in lengths]
        texts[5][:13] = texts[2][:13]
        doc = rng.permutation(12)
        codes, ends = np.concatenate(texts), np.cumsum(lengths)
        got = substring.factored(codes, np.repeat(np.arange(12), lengths), doc, ends)
        first = {}
        for d, t in zip(doc, texts):
            for p in range(len(t) - 12):
                first[t[p : p + 13].tobytes()] = min(d, first.get(t[p : p + 13].tobytes(), 99))
        expected = np.concatenate([[p + 13 <= len(t) and first[t[p : p + 13].tobytes()] < d for p in range(len(t))] for d, t in zip(doc, texts)])
        assert (got == expected).all()


# --- 6: web archives


def test_archives_round_trip(spark, empty):
    data = [(1, "http://a/", "x" * 10), (2, None, "x" * 10), (3, "http://b/ c", None), (4, "u", ""), (5, "u", "é日\r\n\r\n"), (None, "u", "x" * 10), (7, "u", "big" * 200000), (8, "u", "big" * 200000), (9, "u", "lone")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    first = {}
    for i, _, h in data:
        if i is not None:
            first.setdefault(h or "", i)
    for least in (0, 1):
        expected = []
        for i, _, h in data:
            payload = (h or "").encode()
            revisit = len(payload) >= least and first.get(h or "") is not None and first[h or ""] != i
            expected.append((i, len(payload), warc.digest(payload), "revisit" if revisit else "response", first[h or ""] if revisit else None))
        same([tuple(r) for r in warc.read_archives(spark, *warc.write_archives(pages, least)).collect()], expected)
    none = pages.limit(0)
    assert warc.read_archives(spark, *warc.write_archives(none)).count() == 0


def test_record_ids_are_unique_and_name_clashes_do_no_harm(spark):
    """Repeated rows, null ids, and columns named like those of the operator."""
    data = [(1, "u", "x", 8, "k"), (1, "u", "x", 8, "k"), (None, "u", "y", None, None), (None, "u", "y", None, None), (4, "v", "x", 8, "k")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, refers_to long, _key string")
    folder, files = warc.write_archives(pages)
    same([(r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(spark, folder, files).collect()], [(1, "response", None), (1, "response", None), (None, "response", None), (None, "response", None), (4, "revisit", 1)])
    heads = []
    fs, place = warc.shared_files(folder)
    for f in files.collect():
        with fs.open_input_file(f"{place}/{f.file}") as source:
            heads += [warc.parsed(x)[0] for x in warc.records(source)]
    assert len({h["warc-record-id"] for h in heads}) == 5
    assert [h["warc-refers-to-target-uri"] for h in heads if h["warc-type"] == "revisit"] == ["u"]


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a", b"first member" * 5)
        z.writestr("b", b"second", compress_type=zipfile.ZIP_DEFLATED)
        z.writestr("c", b"third member " * 9)
        z.comment = b"PK\x05\x06 in a comment"
    source = pa.BufferReader(buffer.getvalue())
    found = warc.members(source)
    assert set(found) == {"a", "c"}
    assert source.read_at(found["c"][1], found["c"][0]) == b"third member " * 9
    with pytest.raises(ValueError):
        warc.members(pa.BufferReader(b"no archive"))


def test_payload_that_lacks_its_digest_is_refused():
    data = warc.record(uuid.uuid4(), 1, "u", b"payload", None)
    assert warc.row_of(data)[1] == 7
    with pytest.raises(ValueError):
        warc.row_of(data.replace(b"payload\r", b"pAyload\r"))


# --- 7: mixing


def test_mixing(spark, docs, empty):
    got = mixing.mix(docs).collect()
    total = sum(r["size"] for r in got)
    assert len(got) == docs.count()
    assert {r.source for r in got} == {"a", "b", "c", None}
    target = {r.source: (r.target, r.source_size) for r in got}
    assert all(t <= 2 * s + 1e-6 for t, s in target.values()) and abs(sum(t for t, _ in target.values()) - 1.5 * total) < 1
    for source, (t, _) in target.items():
        assert abs(sum(r.taken for r in got if r.source == source) - t) <= 1
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    same(got, mixing.mix(docs.repartition(5)).collect())
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in rows.collect()) == sum(r.taken for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_mixed_keeps_line_breaks_and_lengths(spark):
    text = "\n".join(f"  line {i}\tof text" for i in range(50))
    docs = spark.createDataFrame([(1, text, "a", len(text)), (2, "x y\nz", "b", 5)], "doc_id long, text string, source string, n_chars long")
    rows = mixing.mixed(docs, weights=(1, 1), share=1.3).filter("doc_id = 1").collect()
    cut = [r for r in rows if r.text != text]
    assert len(cut) == 1 and text.startswith(cut[0].text) and "\n" in cut[0].text
    assert all(r.n_chars == len(r.text) for r in rows)


# --- 8: quality


def test_quality_counts_and_order(spark, docs, rows, empty):
    got = quality.quality_rules(docs)
    want = []
    for i, text, *_ in rows:
        text = text or ""
        w = WORD.findall(text)
        windows = collections.Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
        covered = {q for p in range(len(w) - 2) if windows[tuple(w[p : p + 3])] > 1 for q in (p, p + 1, p + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want.append((i, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)))
    same([(r.doc_id, int(r.n_words), r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect()], want)
    assert got.columns == [*(c for c in docs.columns if c not in ("n_words", "kept")), *quality.BASE, "base_failed", "failed_rule", "kept"]
    assert {r["_t"] for r in got.collect()} == {"clash"}
    runs = [quality.order_rules(docs, rules) for rules in (quality.RULES, quality.RULES, quality.RULES[::-1])]
    assert runs[0] == runs[1] and sorted(r.name for r, _, _ in runs[2]) == sorted(r.name for r in quality.RULES)
    for run in runs:
        worth = [max(rejected, quality.LEAST_REJECTED) / max(cost, 1.0) for _, rejected, cost in run]
        assert worth == sorted(worth, reverse=True)
    reverse = quality.quality_rules(docs, quality.RULES[::-1])
    same(got.select("doc_id", "kept").collect(), reverse.select("doc_id", "kept").collect())
    assert quality.quality_rules(empty).count() == 0


def test_a_rule_made_slow_moves_back(spark, docs, empty):
    """Two rules that reject alike: the slower one is asked last, wherever it was given; verdicts stay."""
    quick = quality.Rule("quick", "n_words < 3")
    slow = quality.Rule("slow", "n_words < 3 and size(filter(sequence(1, 3000), x -> x * word_chars < 0)) = 0")
    for rules in ((slow, quick), (quick, slow)):
        order = quality.order_rules(docs, rules)
        assert [r.name for r, _, _ in order] == ["quick", "slow"]
        assert order[0][1] == order[1][1] > 0 and order[1][2] > order[0][2]
    same(quality.quality_rules(docs, (slow, quick)).select("doc_id", "kept").collect(), quality.quality_rules(docs, (quick,)).select("doc_id", "kept").collect())
    never = quality.Rule("never", "n_words < 0")
    assert [r.name for r, _, _ in quality.order_rules(empty, (never, slow))] == ["never", "slow"] and never not in quality._NANOSECONDS


def test_quality_of_a_very_long_text(spark):
    distinct = " ".join(f"w{i}" for i in range(600_000))
    text = distinct + " w5 w6 w7 x w5 w6 w7"
    got = quality.base_features(spark.createDataFrame([(0, distinct), (1, text)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_repeat_words) for r in got] == [(600_000, 0), (600_007, 9)]


def test_repeated_windows_of_equal_hash_bits_are_told_apart(spark):
    """Windows whose hashes agree in the upper bits that are left beside the position; their words decide."""
    words = [f"w{i}" for i in range(300)]
    hashed = spark.range(300).select(F.xxhash64(F.concat(F.lit("w"), "id"), F.lit("a"), F.lit("b")).alias("h"))
    assert hashed.distinct().count() == 300
    text = " ".join(f"{w} a b" for w in words)
    got = quality.base_features(spark.createDataFrame([(text,)], "text string")).first()
    counts = collections.Counter(tuple(text.split()[i : i + 3]) for i in range(898))
    assert got.n_repeat_words == 0 and max(counts.values()) == 1


# --- 9: licenses


def test_license_base_and_suppression(spark, docs, empty):
    texts = ["Licensed under the Apache License, Version 2.0. All rights reserved.", "CC BY-SA 4.0", "mit der Zeit", None, "General PUBLIC license; all rights reserved all rights-reserved cc by", "SPDX-License-Identifier: MIT"]
    got = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.base_labels for r in got] == ["reserved", "cc-by", "", "", "cc-by,gpl,reserved", ""]
    assert "apache-2.0" in got[0].labels and "cc-by-sa-4.0" in got[1].labels and got[2].labels == "" and got[5].labels == "mit"
    assert (got[4].n_base, got[4].first_word, got[4].last_word, got[4].n_words) == (4, 0, 9, 11)
    assert len(licenses.signatures()) > 300 and all(0 <= r.score <= 1 for r in got)
    # A shorter detection inside a longer one of higher priority is suppressed.
    assert sum(h.label.startswith("cc-by") for h in got[1].hits) == 1
    assert licenses.scan_licenses(docs).count() == docs.count() and licenses.scan_licenses(empty).count() == 0


def examples(pattern):
    """Texts that the pattern matches, with every choice of its alternatives and optional parts."""
    from re import _constants as c
    from re import _parser

    def of(parsed):
        out = [""]
        for op, x in parsed:
            if op is c.LITERAL:
                own = [chr(x)]
            elif op is c.BRANCH:
                own = [y for part in x[1] for y in of(part)]
            elif op is c.SUBPATTERN:
                own = of(x[3])
            elif op in (c.MAX_REPEAT, c.POSSESSIVE_REPEAT):
                low, high = x[0], min(x[1], max(1, x[0]))
                own = [y * n for n in range(low, high + 1) for y in of(x[2])]
            elif op is c.IN:
                own = [chr(v) if k is c.LITERAL else chr(v[0]) if k is c.RANGE else "x" for k, v in x]
            else:
                assert op in (c.ASSERT, c.ASSERT_NOT)  # they take no text
                continue
            out = [a + b for a in out for b in dict.fromkeys(own)]
        return out

    return of(_parser.parse(pattern))


def test_every_match_of_a_license_rule_holds_a_keyword():
    for rule in licenses.signatures():
        found = [t for t in (" " + re.sub(r"[^a-z0-9]+", " ", x) + " " for x in examples(rule.pattern)) if re.search(f" (?:{rule.pattern})(?= )", t)]
        assert found and all(any(" " + k in t for k in rule.keywords) for t in found), rule


def test_license_rules_of_several_keywords(spark):
    texts = ["GNU Library General Public License, version 2", "It may not be copied.", "Do not copy", "Creative Commons Zero", "the FreeBSD license", "for noncommercial use only", "Open Data Commons Database License 1.0"]
    got = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in got] == ["gpl,lgpl-2", "no-redistribution", "no-redistribution", "cc0", "bsd-2", "non-commercial", "odbl-1.0"]


def scanned(text):
    """The scan restated: words, base places and labels, and the detections that no other one suppresses, by comparing all pairs."""
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    flat = "".join(f" {w}" for w in words) + " "
    places = sorted((i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    hits = []
    for rule in licenses.signatures():
        for m in re.finditer(f" (?:{rule.pattern})(?= )", flat):
            start = flat[: m.start()].count(" ")
            hits.append((start, start + m[0].count(" "), rule.priority, rule.label))
    beats = lambda b, a: b[0] <= a[0] and b[1] >= a[1] and (b[2] > a[2] or (b[2] == a[2] and b[1] - b[0] > a[1] - a[0]))
    kept = [a for a in hits if not any(beats(b, a) for b in hits)]
    base = sorted({x for _, x in places})
    labels = sorted({*base, *(h[3] for h in kept)})
    at = [i for i, _ in places]
    score = max(0.5 * bool(base), max((h[2] for h in kept), default=0) / 5)
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(base), ",".join(labels), score, sorted((h[3], h[0], h[1] - h[0]) for h in kept)


def test_license_scan_equals_brute_force(spark, docs, rows):
    rng = np.random.default_rng(12)
    rules = licenses.signatures()
    found = [x for r in rules[::9] for x in examples(r.pattern)[:2]]
    texts = [" ".join(rng.choice(found, 6)) + rng.choice(["", " all rights reserved", " filler cc by "]) for _ in range(60)]
    texts += ["GNU Lesser General Public License, version 2.1 or later", "MIT License. " * 5 + "licensed under the MIT license", "Ünïcödé cc by ÄÖ", "cc by cc by", None, ""]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for df, want in ((asked, list(enumerate(texts))), (docs, [r[:2] for r in rows])):
        got = licenses.scan_licenses(df).collect()
        same([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 6), sorted((h.label, h.first_word, h.words) for h in r.hits)) for r in got], [(i, *scanned(t)) for i, t in want])
    assert {r["_t"] for r in licenses.scan_licenses(docs).select("_t").collect()} == {"clash"}


def test_many_matches_of_one_text_take_no_square_of_time(spark):
    import time

    df = spark.createDataFrame([(1, "the mit license and " * 60_000)], "doc_id long, text string")
    began = time.time()
    got = licenses.scan_licenses(df).select("labels", F.size("hits")).first()
    assert got[0] == "mit" and got[1] == 60_000 and time.time() - began < 60


# --- 10: SimHash


def fingerprint(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(values):
    label = list(range(len(values)))
    while True:
        new = [min(label[j] for j in range(len(values)) if bin(values[i] ^ values[j]).count("1") <= 3) for i in range(len(values))]
        if new == label:
            return label
        label = new


def test_simhash_equals_brute_force(docs, rows, empty):
    values = [fingerprint(t) for _, t, *_ in rows]
    label = smallest(values)
    least = {}
    for k, (i, *_) in zip(label, rows):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    same([tuple(r) for r in simhash.near_duplicates(docs).collect()], [(i, f"{v:016x}", least.get(k)) for (i, *_), v, k in zip(rows, values, label)])
    assert simhash.near_duplicates(empty).count() == 0


def test_hot_keys_are_tiled_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 1, dtype=np.uint64)
    values = np.unique(centre ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (400, 3)).astype(np.uint64), axis=1))
    monkeypatch.setattr(simhash, "HOT", 64)
    df = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fp long")
    edges = {(r.a, r.b) for r in simhash.edges_of(df, len(values)).collect()}
    parent = {int(x): int(x) for x in values.view(np.int64)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        assert bin((a ^ b) & (2**64 - 1)).count("1") >= 1
        parent[root(a)] = root(b)
    label = smallest([int(x) for x in values])
    groups = collections.defaultdict(set)
    for x, k in zip(values.view(np.int64).tolist(), label):
        groups[k].add(root(x))
    assert all(len(x) == 1 for x in groups.values()) and len({x for g in groups.values() for x in g}) == len(groups)


def test_group_forests_agree():
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = np.unique(rng.choice(centres, 150) ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (150, 4)).astype(np.uint64), axis=1))
    assert simhash.forest_of_group(values).tolist() == smallest([int(x) for x in values])


def test_byte_characters_are_distinct():
    chars = bpe.byte_characters()
    assert len(set(chars)) == 256 and chars[ord("A")] == "A" and chars[:3] == ["Ā", "ā", "Ă"]

import collections
import hashlib

import numpy as np

import corpus_pipeline
from quillon.llm import langid, mixing

from .test_operators import WORD, library, removed, same


def near_kept(rows):
    """What stays of rows (doc_id, text and more): of each group of texts that are linked at similarity 0.8 one row of the smallest doc_id."""
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    own = [k for k, (i, *_) in enumerate(rows) if i is not None]
    label = {k: k for k in own}
    while True:
        new = {a: min(label[b] for b in own if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])) for a in own}
        if new == label:
            break
        label = new
    least = {}
    for k in own:
        least[label[k]] = min(least.get(label[k], rows[k][0]), rows[k][0])
    kept = {}
    for k in own:
        if rows[k][0] == least[label[k]]:
            kept.setdefault(label[k], rows[k])
    return list(kept.values()) + [r for r in rows if r[0] is None]


def test_each_stage_on_its_own_input(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, "").collect()
    assert {r.doc_id for r in kept if r.doc_id is not None} == {i for i, t, *_ in rows if i is not None and any(c.isalpha() for c in t or "")}
    one = stages["simhash_near_dedup"](spark, docs, "").collect()
    same([(r.doc_id, r.text) for r in one], near_kept([(i, t) for i, t, *_ in rows]))
    cut = stages["substring_dedup"](spark, docs, "")
    assert cut.columns == docs.columns
    texts = {i: t for i, t, *_ in rows}
    expected = collections.Counter((i, kept if gone else texts[i]) for i, _, gone, kept in removed(rows) if i is not None)
    assert collections.Counter((r.doc_id, r.text) for r in cut.collect() if r.doc_id is not None) == expected
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.collect() if r.doc_id is not None and r.text != texts[r.doc_id])
    taken = {r.doc_id: r.taken for r in mixing.mix(docs.filter("doc_id < 90")).collect()}
    mixed = collections.Counter()
    for r in stages["mix_sources"](spark, docs.filter("doc_id < 90"), "").collect():
        mixed[r.doc_id] += len(WORD.findall(r.text))
    assert mixed == collections.Counter({k: v for k, v in taken.items() if v})
    tk = library()
    for r in stages["bpe"](spark, docs.filter("doc_id < 98"), "").collect():
        assert r.n_tokens == len(tk.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)


def slow_score(network, text):
    """The best language's probability by plain convolution: every filter at every place of every window, weighted by bytes."""
    data = text.encode()
    sums, total = np.zeros(len(network.languages)), 0
    for at in range(0, len(data), langid.WINDOW):
        window = data[at : at + langid.WINDOW]
        e = network.embedding[np.frombuffer(window.ljust(langid.WINDOW, b"\0"), np.uint8)]
        pooled = np.concatenate([np.max([e[i : i + n].ravel() @ w for i in range(langid.WINDOW - n + 1)], axis=0) for n, w in zip(langid.WIDTHS, network.filters)])
        logits = np.maximum(pooled + network.bias, 0) @ network.out + network.out_bias
        sums += len(window) * (logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max())
        total += len(window)
    p = np.exp(sums / total - (sums / total).max())
    return float(p.max() / p.sum())


def slow_mix(rows):
    """Rows of the mix: whole copies, and the first words of the document that a source's fractional epoch ends in."""
    size = lambda r: len(WORD.findall(r[1] or ""))
    names = sorted({r[3] for r in rows}, key=lambda x: (x is None, x or ""))
    sizes = {n: sum(size(r) for r in rows if r[3] == n) for n in names}
    weight = {n: mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for i, n in enumerate(names)}
    left, going, target = 1.5 * sum(sizes.values()), set(names), {}
    while going:
        level = left / sum(weight[n] for n in going)
        over = [n for n in going if level * weight[n] >= 2 * sizes[n]]
        for n in over or list(going):
            target[n] = 2 * sizes[n] if over else level * weight[n]
            left -= target[n]
            going.discard(n)
    for n in names:
        whole = int(target[n] // sizes[n]) if sizes[n] else 0
        part = round(target[n] - whole * sizes[n])
        key = lambda r: hashlib.md5(f"{mixing.SEED}:{'' if r[0] is None else r[0]}:{hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest()
        for r in sorted((r for r in rows if r[3] == n and size(r)), key=key):
            extra = min(size(r), part)
            part -= extra
            yield from [r] * (whole + (size(r) == extra))
            if 0 < extra < size(r):
                end = list(WORD.finditer(r[1]))[extra - 1].end()
                yield (r[0], r[1][:end], *r[2:])


def test_run_equals_brute_force_stages(spark, rows, tmp_path):
    """The whole pipeline against slow stages one after the other: nulls, repeated rows, empty and long texts included."""
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    network, tk = langid.fit(docs), library()
    own = [r for r in rows if any(c.isalpha() for c in r[1] or "") and slow_score(network, r[1]) >= corpus_pipeline.LEAST_SCORE]
    own = near_kept(own)
    own = [(i, kept if gone else r[1], *r[2:]) for r, (i, _, gone, kept) in zip(own, removed(own))]
    want = []
    for i, text, _, source, _ in slow_mix(own):
        ids = tk.encode(text, add_special_tokens=False).ids
        want.append((i, source, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) > 60 and any(r.doc_id is None for r in got) and any(r.source is None for r in got)
    same([(r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got], want)


def test_near_copies_at_the_similarity_go(spark):
    import random

    from .conftest import SCHEMA, prose

    rng, out, shingles = random.Random(11), [], {}
    for i in range(0, 400, 2):
        words = [prose(rng, 200, 5000).split()] * 2
        words[1] = list(words[0])
        for k in rng.sample(range(200), rng.randrange(1, 8)):
            words[1][k] = "changed"
        out += [(i, " ".join(words[0])), (i + 1, " ".join(words[1]))]
    out += [(1000, "one two"), (1001, "One  two"), (1002, "one three"), (1003, None), (1004, " "), (None, out[0][1])]
    for i, t in out:
        words = (t or "").lower().split()
        shingles[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    gone = {i + 1 for i in range(0, 400, 2) if 5 * len(shingles[i] & shingles[i + 1]) >= 4 * len(shingles[i] | shingles[i + 1])}
    assert 50 < len(gone) < 190
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in out], SCHEMA).repartition(3)
    kept = [r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "").collect()]
    assert sorted(i for i in kept if i is not None) == [i for i in range(400) if i not in gone] + [1000, 1002, 1003] and kept.count(None) == 1


def test_large_candidate_components_meet_in_tiles(spark, monkeypatch):
    from quillon.llm import neardup

    from .conftest import SCHEMA

    monkeypatch.setattr(neardup, "TILE_SETS", 8)
    base = [f"w{k}" for k in range(300)]
    out = [(i, " ".join(base[:i] + ["changed"] + base[i + 1 :]), "en", "a", 0) for i in range(40)]
    assert [r.doc_id for r in neardup.drop_near_duplicates(spark.createDataFrame(out, SCHEMA)).collect()] == [0]


def test_rows_of_one_id_with_unrelated_texts_all_stay(spark):
    from pyspark.sql import functions as F

    from .conftest import SCHEMA

    words = [" ".join(f"{x}{k}" for k in range(60)) for x in "abc"]
    out = [(7, words[0]), (7, words[1]), (7, words[1]), (7, None), (8, words[2]), (9, words[2].upper()), (None, words[0]), (None, words[0]), (10, "")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in out], SCHEMA).withColumns({x: F.lit("clash") for x in ("node", "tie", "_row", "root", "first")})
    for stage in ("simhash_near_dedup",):
        got = dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
        assert got.columns == docs.columns
        same([(r.doc_id, r.text) for r in got.collect()], [(7, words[0]), (7, words[1]), (7, None), (8, words[2]), (None, words[0]), (None, words[0])])


def test_stages_on_empty_tables_and_clashing_columns(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
        out = stage(spark, docs, "")
        if name != "bpe":
            assert out.columns == docs.columns and {r._t for r in out.select("_t").distinct().collect()} == {"clash"}

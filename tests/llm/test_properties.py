"""Properties of the parts that need no session."""

import uuid

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.llm import bpe, simhash, substring, tokenfile, warc

from .test_operators import fingerprint, library



def colliding():
    """Units whose hashes are nearly all equal."""
    units = bpe.Units(bpe.codec(bpe.vocabulary_path())[0].encode_units)
    units.hashes = lambda data, starts, ends: ((ends - starts).astype(np.uint64) % np.uint64(2) + np.uint64(1), np.zeros(len(starts), np.uint64))
    return units


TEXT = st.text(alphabet=st.one_of(st.sampled_from("ab  \n\t'sz1.<|endoftext|>　\x1c\x85éß日"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_units_encode_like_the_library(texts):
    tk = library()
    coder, units = bpe.codec(bpe.vocabulary_path())
    for run in (lambda x: units([t.encode() for t in x]), lambda x: tokenfile.library_ids(bpe.vocabulary_path(), x), lambda x: colliding()([t.encode() for t in x])):
        ids, counts = run(texts)
        ends = np.cumsum(counts)
        assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [tk.encode(x, add_special_tokens=False).ids for x in texts]
        assert coder.decode(ids.astype(np.int64), counts) == texts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50_256), st.integers(0, 2**64 - 1)), max_size=700))
def test_words_hold_any_ids(ids):
    values = np.array(ids, np.uint64)
    words, sizes = tokenfile.pack(values)
    n_ids = np.minimum(tokenfile.BLOCK, len(ids) - np.arange(len(sizes)) * tokenfile.BLOCK)
    assert tokenfile.unpack(words, sizes, n_ids).tolist() == ids


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_fingerprints(text):
    assert int(simhash.fingerprints([text.encode("utf-8", "replace"), b""])[0]) == fingerprint(text)


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.none(), st.integers(0, 99)), st.one_of(st.none(), TEXT), st.binary(max_size=80), st.one_of(st.none(), st.integers(0, 99)))
def test_records_parse_back(page, url, payload, refers):
    got = warc.row_of(warc.record(uuid.UUID(int=7), page, url, payload, refers, url))
    assert got == (page, len(payload), warc.digest(payload), "response" if refers is None else "revisit", refers)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=0, max_size=40), max_size=6))
def test_equal_windows_share_anchor_and_offset(rows):
    """Wherever a window's words occur, its piece has the same anchor, so both meet in one block."""
    sizes = np.array([len(r) for r in rows], np.int64)
    codes = np.array([x for r in rows for x in r], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    p = substring.cut_pieces(codes, sizes)
    seen: dict = {}
    covered = 0
    for row, start, windows, anchor in zip(p["row"], p["start"], p["windows"], p["anchor"]):
        for k in range(windows):
            key = tuple(rows[row][start + k : start + k + substring.WINDOW])
            assert len(key) == substring.WINDOW and seen.setdefault(key, anchor) == anchor
            covered += 1
    assert covered == sum(max(0, n - substring.WINDOW + 1) for n in sizes)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 200))
def test_planes_count_like_popcount(seed, n):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 2**63, 1, dtype=np.uint64)
    values = centre ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (n, 4)).astype(np.uint64), axis=1)
    bits = simhash.within(simhash.planes_of(values), values)
    near = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)
    assert (near == (np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)).all()

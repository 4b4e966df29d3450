"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

What counts as duplicate: every window of WINDOW consecutive words whose word sequence also starts in a document with a smaller
doc_id. All words of such windows are removed; windows are judged on the input.

Blocks. Comparing every document with all text is out of reach, so text is cut by content: in each window the 5-word gram of
least hash is its anchor (the leftmost of equal ones), and a run of windows with one anchor is a piece. Equal windows have
equal anchors, so the reference block of an anchor's hash holds every piece that a window could be copied from.

Parsing. (1) Pieces go to their blocks as hashes only, which tells the anchors that more than one document has. Pieces of all
other anchors are literals. (2) Pieces of shared anchors go to their blocks with the codes of their words. A block indexes all its
pieces by their windows' hashes, and each piece is factored greedily: at a place with a source in a smaller document the factor is
extended word by word as far as the source agrees, else one literal passes. A factor of WINDOW words or more is a duplicate span.
Windows that start inside a factor and end behind it would escape the greedy parse; they are looked up at every factor's end.
Hashes only propose sources; every word of a factor is compared, as its 64-bit code.

A block's size is fixed by the number of blocks, which follows the text. Hot anchors (a phrase in many documents, with other words
around it in each) are split: their pieces are dealt window by window, by the hash of the window's words, so that equal windows
still meet. Copies never meet in numbers: a chunk of documents sends each piece or window once, with its smallest document, and
settles its later copies by itself, comparing their words.

Defined results: a null text has no words; a document shorter than a window loses none; rows with a null doc_id come after all
others and do not remove each other's words; rows of equal doc_id do not remove each other's words; empty tables give empty
results; input columns named like a result column are replaced, all others stay as they are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quillon.llm.bpe import spread
from quillon.llm.common import materialized, pieces, utf8_of, with_fields, without

WINDOW, GRAM = 13, 5
#: Bytes of text for each reference block, of text for each group of documents, and of a chunk of documents that a task cuts.
BLOCK_BYTES, GROUP_BYTES, CUT_BYTES = 12 << 20, 4 << 20, 2 << 20
#: Distinct words whose codes a task remembers.
MOST_WORDS = 100_000
NO_ID = np.iinfo(np.int64).max
#: Names of the columns that rows carry on the way.
TAG, GROUP = "\x01tag", "\x01grp"
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

ENTRY = (("anchor", "<u4"), ("whole", "<u8"), ("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("windows", "u1"))
SPAN = (("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("windows", "u1"))
#: What a blob for a group of documents says of its spans: gone, to be parsed as pieces, to be parsed window by window.
DUPLICATE, OPEN, SINGLE = 1, 2, 3
#: Pieces of one anchor in a chunk, and in a block, beyond which the anchor is hot.
HOT_IN_CHUNK, HOT_IN_BLOCK = 64, 20_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Codes(dict):
    """64-bit codes of words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code

    def __call__(self, words: list[list[bytes]], total: int) -> np.ndarray:
        if len(self) > MOST_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(words)), np.uint64, total)


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place on; 0-padded at the end."""
    out = np.zeros(len(codes), np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for i in range(min(n, len(codes))):
            out[: len(codes) - i] += codes[i:] * factor
            factor *= STEP
        return mixed(out)


def cut_pieces(codes: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Pieces of documents (sizes: words of each): row, start (first word), windows, anchor and whole (hashes), first (place in codes)."""
    n = len(codes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(n) - firsts[row]
    valid = place + WINDOW <= sizes[row]
    least, off, span = gram_hashes(codes, GRAM), np.zeros(n, np.uint8), 1
    singles = least

    def joined(v, o, w, q, by):
        """The least of a window at each place and of one that starts `by` places on."""
        right = np.concatenate([w[by:], np.full(min(by, n), np.iinfo(np.uint64).max)])
        other = np.concatenate([q[by:], np.zeros(min(by, n), np.uint8)]) + np.uint8(by)
        less = right < v
        return np.where(less, right, v), np.where(less, other, o)

    while 2 * span <= WINDOW - GRAM + 1:
        least, off = joined(least, off, least, off, span)
        span *= 2
    while span < WINDOW - GRAM + 1:
        least, off = joined(least, off, singles, np.zeros(n, np.uint8), span)
        span += 1
    at = np.flatnonzero(valid)
    anchor = at + off[at]
    fresh = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[at[1:]] != row[at[:-1]])])) if len(at) else at
    windows = np.diff(np.concatenate([fresh, [len(at)]]))
    first = at[fresh]
    with np.errstate(over="ignore"):
        powers = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, STEP))])
        inverse = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, BACK))])
        sums = np.concatenate([[np.uint64(0)], np.add.accumulate(codes * powers[:n])]) if n else np.zeros(1, np.uint64)
        last = first + windows + WINDOW - 1
        whole = mixed((sums[last] - sums[first]) * inverse[first] + windows.astype(np.uint64) * STEP)
    return {"row": row[first], "start": place[first], "windows": windows, "anchor": mixed(least[first]), "whole": whole, "first": first}


def pack(columns, fields) -> bytes:
    """Columns of equal length as one compressed value; ascending columns are stored as differences."""
    parts = [np.diff(columns[k].astype(t), prepend=columns[k].dtype.type(0)).astype(t) if k in ("doc", "start") else columns[k].astype(t) for k, t in fields]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in parts))


def unpack(blob: bytes, fields) -> dict[str, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = len(data) // sum(np.dtype(t).itemsize for _, t in fields)
    out, at = {}, 0
    with np.errstate(over="ignore"):
        for k, t in fields:
            x = np.frombuffer(data, t, n, at)
            at += n * x.itemsize
            out[k] = np.cumsum(x, dtype=t) if k in ("doc", "start") else x
    return out


def together(blobs: list[bytes], fields) -> dict[str, np.ndarray]:
    each = [unpack(x, fields) for x in blobs]
    return {k: np.concatenate([x[k] for x in each]) if each else np.empty(0, t) for k, t in fields}


def by_group(columns: dict[str, np.ndarray], fields, group: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """For each group its rows as one blob, in the order given."""
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield int(group[rows[0]]), pack({k: columns[k][rows] for k, _ in fields}, fields)


def prime_from(n: int) -> int:
    while any(n % i == 0 for i in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def group_of(doc: np.ndarray, tag: np.ndarray, groups: int) -> np.ndarray:
    """The group of documents of each span; rows of one doc_id, or of none, are spread by their texts' tags."""
    return (doc % groups + tag.astype(np.int64)) % groups


def copies_of_smaller(keys: list[np.ndarray], first: np.ndarray, size: np.ndarray, doc: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which runs of words (size of them from first on, in order of doc) are copies of one of a smaller document among them: found by keys, then compared word by word."""
    out = np.zeros(len(doc), bool)
    if not len(doc):
        return out
    order = np.lexsort((np.arange(len(doc)), *keys))
    fresh = np.zeros(len(doc), bool)
    fresh[0] = True
    for k in keys:
        fresh[1:] |= k[order[1:]] != k[order[:-1]]
    lead = np.empty(len(doc), np.int64)
    lead[order] = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    asked = np.flatnonzero((doc > doc[lead]) & (size == size[lead]))
    unequal = np.flatnonzero(codes[spread(first[asked], size[asked])] != codes[spread(first[lead[asked]], size[asked])])
    out[asked] = True
    out[asked[np.searchsorted(np.cumsum(size[asked]), unequal, "right")]] = False
    return out


class Documents:
    """Words and codes of some rows, by ascending doc_id."""

    def __init__(self, batch, codes: Codes):
        ids = np.array([NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
        texts = utf8_of(batch)
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        texts = [texts[i] for i in self.order]
        self.tags = batch.column(TAG).to_numpy(zero_copy_only=False).astype(np.uint32)[self.order]
        self.words = [x.split() for x in texts]
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.codes = codes(self.words, int(self.sizes.sum()))
        self.firsts = np.cumsum(self.sizes) - self.sizes

    def places(self, spans: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For spans of (doc, tag): the rows that they are of, and which span; a span counts for each such row."""
        key = np.array(list(zip(self.ids.tolist(), self.tags.tolist())), np.dtype([("a", "<i8"), ("b", "<u4")])) if len(self.ids) else np.empty(0, np.dtype([("a", "<i8"), ("b", "<u4")]))
        wanted = np.empty(len(spans["doc"]), key.dtype)
        wanted["a"], wanted["b"] = spans["doc"], spans["tag"]
        order = np.argsort(key, order=("a", "b"), kind="stable")
        low, high = np.searchsorted(key[order], wanted, "left"), np.searchsorted(key[order], wanted, "right")
        counts = high - low
        which = np.repeat(np.arange(len(wanted)), counts)
        return order[low[which] + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)], which


def sent_pieces(batches: Iterator[pa.RecordBatch], blocks: int, groups: int) -> Iterator[pa.RecordBatch]:
    """(cell, kind, data): pieces for blocks (cell = block), and spans of which a chunk knows what they are (cell = -1 - group).
    An anchor that is hot in the chunk goes to its block once, as a piece without windows."""
    codes = Codes()
    for batch in batches:
        for part in pieces(batch, "text", CUT_BYTES):
            docs = Documents(part, codes)
            p = cut_pieces(docs.codes, docs.sizes)
            p |= {"doc": docs.ids[p["row"]], "tag": docs.tags[p["row"]]}
            later = copies_of_smaller([p["whole"], p["anchor"]], p["first"], p["windows"] + WINDOW - 1, p["doc"], docs.codes)
            rows = []
            group = group_of(p["doc"], p["tag"], groups)
            _, number, count = np.unique(p["anchor"], return_inverse=True, return_counts=True)
            hot = ~later & (count[number] > HOT_IN_CHUNK)
            for kind, chosen in ((DUPLICATE, later), (SINGLE, hot)):
                rows += [(-1 - g, kind, d) for g, d in by_group({k: p[k][chosen] for k, _ in SPAN}, SPAN, group[chosen])]
            p["windows"] = np.where(hot, 0, p["windows"])
            once = np.zeros(len(hot), bool)
            once[np.flatnonzero(hot)[np.unique(p["anchor"][hot], return_index=True)[1]]] = True
            rest = {k: p[k][~later & (~hot | once)] for k, _ in ENTRY}
            block = ((rest["anchor"] >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
            rest["anchor"] = rest["anchor"] & np.uint64(0xFFFFFFFF)
            rows += [(c, 0, d) for c, d in by_group(rest, ENTRY, block)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["cell", "kind", "data"])


def shared_pieces(table: pa.Table, groups: int) -> pa.Table:
    """Of one block: pieces whose anchor other documents have too, as blobs for groups of documents: OPEN, or SINGLE if the anchor
    is hot. A cell below 0 passes."""
    cell = table.column("cell")[0].as_py()
    if cell < 0:
        return pa.table({"grp": pa.array([-1 - cell] * len(table), pa.int64()), "kind": table.column("kind"), "data": table.column("data")})
    e = together(table.column("data").to_pylist(), ENTRY)
    order = np.argsort(e["anchor"], kind="stable")
    e = {k: v[order] for k, v in e.items()}
    fresh = np.concatenate([[True], e["anchor"][1:] != e["anchor"][:-1]])
    anchor, heads = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    low, high = np.minimum.reduceat(e["doc"], heads), np.maximum.reduceat(e["doc"], heads)
    hot = (np.minimum.reduceat(e["windows"], heads) == 0) | (np.diff(np.append(heads, len(fresh))) > HOT_IN_BLOCK)
    mine = e["windows"] > 0
    rows = []
    for kind, chosen in ((SINGLE, mine & hot[anchor]), (OPEN, mine & (~hot & (low < high))[anchor])):
        at = np.flatnonzero(chosen)
        at = at[np.lexsort((e["start"][at], e["tag"][at], e["doc"][at]))]
        spans = {k: e[k][at] for k, _ in SPAN}
        rows += [(g, kind, d) for g, d in by_group(spans, SPAN, group_of(spans["doc"], spans["tag"], groups))]
    return pa.table({"grp": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([r[1] for r in rows], pa.int32()), "data": pa.array([r[2] for r in rows], pa.binary())})


def spans_of(table: pa.Table, kind: int) -> dict[str, np.ndarray]:
    return together([d for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()) if k == kind], SPAN)


def sent_words(docs: pa.Table, spans: pa.Table, blocks: int, groups: int) -> pa.Table:
    """Shared pieces of a group of documents with the codes of their words, as blobs for blocks (cell, data, codes), the windows
    of hot anchors by their own hash. Spans that are copies within the group go to cell -1 - group, without codes."""
    rows = []
    opened, single = spans_of(spans, OPEN), spans_of(spans, SINGLE)
    codes = Codes()
    for batch in docs.to_batches() if len(opened["doc"]) + len(single["doc"]) else []:
        for part in pieces(batch, "text", CUT_BYTES):
            d = Documents(part, codes)
            p = cut_pieces(d.codes, d.sizes)
            # A piece by its row and start; windows of a hot one stand for themselves.
            width = int(d.sizes.max(initial=0)) + 1
            mark = p["row"] * width + p["start"]
            row, which = d.places(opened)
            at = np.searchsorted(mark, row * width + opened["start"][which])
            own = {k: p[k][at] for k in ("row", "start", "windows", "first")} | {"key": p["whole"][at], "cell": ((p["anchor"][at] >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)}
            row, which = d.places(single)
            if len(row):
                n = single["windows"][which].astype(np.int64)
                first = spread(d.firsts[row] + single["start"][which], n)
                key = gram_hashes(d.codes, WINDOW)[first]
                each = {"row": np.repeat(row, n), "start": spread(single["start"][which].astype(np.int64), n), "windows": np.ones(len(first), np.int64), "first": first, "key": key, "cell": blocks + (key % np.uint64(blocks)).astype(np.int64)}
                own = {k: np.concatenate([v, each[k]]) for k, v in own.items()}
            order = np.lexsort((own["start"], d.ids[own["row"]], own["cell"]))
            own = {k: v[order] for k, v in own.items()}
            own |= {"doc": d.ids[own["row"]], "tag": d.tags[own["row"]]}
            size = own["windows"] + WINDOW - 1
            later = np.zeros(len(size), bool)
            for hot in (own["cell"] < blocks, own["cell"] >= blocks):
                by_doc = np.flatnonzero(hot)
                by_doc = by_doc[np.argsort(own["doc"][by_doc], kind="stable")]
                later[by_doc] = copies_of_smaller([own["key"][by_doc]], own["first"][by_doc], size[by_doc], own["doc"][by_doc], d.codes)
            if later.any():
                again = {k: own[k][later] for k, _ in SPAN}
                again_at = np.lexsort((again["start"], again["tag"], again["doc"]))
                again = {k: v[again_at] for k, v in again.items()}
                rows += [(-1 - g, x, b"") for g, x in by_group(again, SPAN, group_of(again["doc"], again["tag"], groups))]
            at = np.flatnonzero(~later)
            for some in np.split(at, np.flatnonzero(np.diff(own["cell"][at])) + 1) if len(at) else []:
                words = d.codes[spread(own["first"][some], size[some])]
                rows.append((int(own["cell"][some[0]]), pack({k: own[k][some] for k, _ in SPAN}, SPAN), zstandard.ZstdCompressor(level=1).compress(words.astype("<u8").tobytes())))
    return pa.table({"cell": pa.array([r[0] for r in rows], pa.int64()), "data": pa.array([r[1] for r in rows], pa.binary()), "codes": pa.array([r[2] for r in rows], pa.binary())})


def factored(codes: np.ndarray, piece: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which places of the reference text start a duplicate window.

    codes: words of all pieces of a block, one after the other; piece: the piece of each word; doc and ends: of each piece its
    document and the place behind its last word. All pieces are parsed at once, each at a place of its own.
    """
    n = len(codes)
    starts = np.flatnonzero(np.arange(n) + WINDOW <= ends[piece])
    seeds = gram_hashes(codes, WINDOW)[starts]
    # The index: for every window the place of its first copy, by document.
    order = np.lexsort((starts, doc[piece[starts]], seeds))
    fresh = np.concatenate([[True], seeds[order[1:]] != seeds[order[:-1]]])
    source = np.full(n, -1)
    source[starts[order]] = starts[order[np.flatnonzero(fresh)]][np.cumsum(fresh) - 1]
    copied = source >= 0
    copied[copied] = doc[piece[source[copied]]] < doc[piece[np.flatnonzero(copied)]]
    at = np.flatnonzero(copied)
    for i in range(WINDOW):  # equal hashes are checked word by word
        at = at[codes[at + i] == codes[source[at] + i]]
    has_source = np.zeros(n, bool)
    has_source[at] = True
    out = np.zeros(n, bool)
    firsts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
    lasts = ends[piece[firsts]]
    now = firsts.copy()
    while True:
        going = now + WINDOW <= lasts
        if not going.any():
            return out
        p, limit = now[going], lasts[going]
        match = has_source[p]
        size = np.where(match, WINDOW, 1)
        # The factor grows as long as its source agrees and neither piece ends.
        grow = np.flatnonzero(match)
        while len(grow):
            a, b = p[grow] + size[grow], source[p[grow]] + size[grow]
            inside = (a < limit[grow]) & (b < ends[piece[source[p[grow]]]])
            grow, a, b = grow[inside], a[inside], b[inside]
            grow = grow[codes[a] == codes[b]]
            size[grow] += 1
        for k in range(int((size - WINDOW).max(initial=-1)) + 1):
            out[p[match & (size - WINDOW >= k)] + k] = True
        # Windows that start in a factor and end behind it.
        for k in range(1, WINDOW):
            q = p[match] + size[match] - k
            q = q[q + WINDOW <= limit[match]]
            out[q[has_source[q]]] = True
        now[going] = p + size


def factored_block(table: pa.Table, groups: int) -> pa.Table:
    """Duplicate spans of the pieces of one block, as blobs for groups of documents. A cell below 0 passes."""
    cell = table.column("cell")[0].as_py()
    if cell < 0:
        return pa.table({"grp": pa.array([-1 - cell] * len(table), pa.int64()), "kind": pa.array([DUPLICATE] * len(table), pa.int32()), "data": table.column("data")})
    e = together(table.column("data").to_pylist(), SPAN)
    codes = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x) for x in table.column("codes").to_pylist()), "<u8")
    size = e["windows"].astype(np.int64) + WINDOW - 1
    ends = np.cumsum(size)
    piece = np.repeat(np.arange(len(size)), size)
    found = np.flatnonzero(factored(codes, piece, e["doc"], ends))
    # Neighbouring windows of a piece are one span, of as many windows as a byte holds at most.
    own = piece[found]
    place = found - (ends - size)[own]
    head = np.ones(len(found), bool)
    head[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1] + 1)
    heads = np.flatnonzero(head)
    spans = {"doc": e["doc"][own[heads]], "tag": e["tag"][own[heads]], "start": e["start"][own[heads]].astype(np.int64) + place[heads], "windows": np.diff(np.append(heads, len(found)))}
    order = np.lexsort((spans["start"], spans["tag"], spans["doc"]))
    spans = {k: v[order] for k, v in spans.items()}
    rows = list(by_group(spans, SPAN, group_of(spans["doc"], spans["tag"], groups)))
    return pa.table({"grp": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([DUPLICATE] * len(rows), pa.int32()), "data": pa.array([r[1] for r in rows], pa.binary())})


def cleaned(docs: pa.Table, spans: pa.Table, schema: pa.Schema) -> pa.Table:
    """Rows of a group of documents with their counts and the words that stay."""
    found = spans_of(spans, DUPLICATE)
    out = []
    codes = Codes()
    for batch in docs.to_batches():
        for part in pieces(batch, "text", CUT_BYTES):
            d = Documents(part, codes)
            row, which = d.places(found)
            edge = np.zeros(len(d.codes) + 1, np.int64)
            begin = d.firsts[row] + found["start"][which].astype(np.int64)
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + found["windows"][which] + WINDOW - 1, -1)
            gone = np.cumsum(edge)[:-1] > 0
            n_removed, kept = np.zeros(len(part), np.int64), [""] * len(part)
            sizes = np.zeros(len(part), np.int64)
            for i, words in enumerate(d.words):
                cut = gone[d.firsts[i] : d.firsts[i] + len(words)]
                j = d.order[i]
                sizes[j], n_removed[j] = len(words), cut.sum()
                kept[j] = b" ".join(itertools.compress(words, (~cut).tolist()) if n_removed[j] else words).decode()
            part = part.select([x for x in part.schema.names if x in schema.names])
            out.append(pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes), pa.array(n_removed), pa.array(kept, pa.string())], [*part.schema.names, "n_words", "n_removed", "kept_text"]))
    return pa.Table.from_batches(out).cast(schema) if out else schema.empty_table()


def drop_duplicate_spans(docs: DataFrame) -> DataFrame:
    """docs with n_words, n_removed and kept_text (the words that stay, joined by one space); text is left as it is."""
    docs = without(docs, "n_words", "n_removed", "kept_text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, groups = total // BLOCK_BYTES + 1, prime_from(total // GROUP_BYTES + 2)
    # Two more columns for the way: a tag of the text, and the group of documents.
    tag = F.xxhash64("text").bitwiseAND(0xFFFFFFFF)
    group = F.pmod(F.pmod(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.lit(groups)) + tag, F.lit(groups))
    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tag.alias(TAG)).mapInArrow(lambda x: sent_pieces(x, blocks, groups), "cell long, kind int, data binary")
    span_type = "grp long, kind int, data binary"
    known = materialized(sent.groupBy("cell").applyInArrow(lambda x: shared_pieces(x, groups), span_type), "pieces")
    dealt = docs.withColumns({TAG: tag, GROUP: group})
    sent = dealt.groupBy(GROUP).cogroup(known.groupBy("grp")).applyInArrow(lambda a, b: sent_words(a, b, blocks, groups), "cell long, data binary, codes binary")
    rest = sent.groupBy("cell").applyInArrow(lambda x: factored_block(x, groups), span_type)
    result = with_fields(docs, "n_words long, n_removed long, kept_text string")
    arrow = to_arrow_schema(result)
    spans = known.filter(F.col("kind") == DUPLICATE).unionByName(rest)
    return dealt.groupBy(GROUP).cogroup(spans.groupBy("grp")).applyInArrow(lambda a, b: cleaned(a, b, arrow), result)

"""SimHash near-duplicates: fingerprints that differ in at most RADIUS of 64 bits are linked; components are the groups.

Candidates: the 64 bits are five fields; two fingerprints within three bits agree on at least two whole fields, so each of
the ten pairs of fields is a key, and only fingerprints with an equal key are compared. That loses no link.

Comparison is bit-sliced: the fingerprints of a key stand in 64 vertical bit planes, 64 of them side by side in one word. A
query's bit is xored to a whole plane, and carry-save counters of two bits and an overflow bit count up 64 distances at a
time; blocks of which every distance has overflowed are left out of the remaining planes.

Hot keys: a key with over HOT fingerprints is dealt out in tiles of two of its chunks, so a task never holds more than one
tile. A tile returns no pairs but a forest: each fingerprint with the smallest it is connected to within the tile. Equal
fingerprints are one node from the start, so exact copies never meet in a comparison.

Defined results: a text that is null or has no word has fingerprint zero, linked like any other; a text of fewer words than a
shingle is one shingle; rows with a null doc_id are grouped too, but never give a component its id unless nothing else is in
it (then it is null); repeated rows share fingerprint and component; empty tables give empty results; input columns named
like a result column are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import discard, materialized, pieces, utf8_of, with_fields, without
from quillon.llm.components import components

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Fields of the fingerprint (first bit, bits); two of them make a key.
FIELDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of a key that are compared in one piece; more are dealt out in tiles of that size.
HOT = 8192
#: Rows that one task of comparisons aims at.
CELL_ROWS = 50_000
#: Groups of up to this many fingerprints are compared together, shifted against each other.
SMALL = 32
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

# Lanes: bit k of a byte as a count in byte k of a word.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1).view(np.uint64)


def fingerprints(texts: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each UTF-8 text."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = list(itertools.accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        n = max(1, len(words) - shingle + 1)
        hashes += [digest(joined[a : b - 1], seed) for a, b in zip(starts[:n], ends[min(shingle, len(words)) - 1 :])]
        sizes[i] = n
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    h = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    # Byte counters hold up to 255 shingles; their sums are added up for each text.
    n = sizes[full]
    parts = -(-n // 255)
    first = np.cumsum(parts) - parts
    heads = np.repeat(np.cumsum(n) - n, parts) + 255 * (np.arange(int(parts.sum())) - np.repeat(first, parts))
    for k in range(8):
        counts = np.add.reduceat(np.add.reduceat(LANES[h[:, k]], heads).view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for bit in range(8):
            out[full] |= (2 * counts[:, bit] > n).astype(np.uint64) << np.uint64(8 * k + bit)
    return out


def planes_of(values: np.ndarray) -> np.ndarray:
    """Vertical bit planes of values (64-bit words, or rows of them): word w of plane p holds bit p of values 64 w to 64 w + 63."""
    own = bits_of(values)
    bits = np.zeros((-(-len(values) // 64) * 64, own.shape[1]), np.uint8)
    bits[: len(values)] = own
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


class Counter:
    """Carry-save counters of many distances, side by side in words: as many bit planes as the radius needs, preset so that a
    distance beyond the radius carries out of the last one, and a plane that keeps this overflow."""

    def __init__(self, shape: tuple[int, ...], radius: int = RADIUS):
        bits = radius.bit_length()
        preset = (1 << bits) - 1 - radius
        self.planes = [np.full(shape, FULL if preset >> b & 1 else 0, np.uint64) for b in range(bits)]
        self.over = np.zeros(shape, np.uint64)

    def add(self, x: np.ndarray) -> None:
        for plane in self.planes:
            carry = plane & x
            plane ^= x
            x = carry
        self.over |= x

    def keep(self, words: np.ndarray) -> None:
        self.planes, self.over = [x[:, words] for x in self.planes], self.over[:, words]


def bits_of(values: np.ndarray) -> np.ndarray:
    """(values, bits) as 0 and 1; values are 64-bit words or rows of them."""
    rows = np.ascontiguousarray(values.reshape(len(values), -1), "<u8")
    return np.unpackbits(rows.view(np.uint8).reshape(len(values), -1), axis=1, bitorder="little")


def within(planes: np.ndarray, queries: np.ndarray, step: int = 8, radius: int = RADIUS) -> np.ndarray:
    """Bit matrix (queries, words): which of the values in planes differ from each query in at most radius bits."""
    bits = bits_of(queries).astype(bool)
    out = np.zeros((len(queries), planes.shape[1]), np.uint64)
    alive = np.arange(planes.shape[1])
    count = Counter(out.shape, radius)
    for p in range(0, len(planes), step):
        for q in range(p, p + step):
            count.add(planes[q][alive][None, :] ^ np.where(bits[:, q], FULL, np.uint64(0))[:, None])
        left = ~(count.over == FULL).all(axis=0)
        if not left.all():
            alive = alive[left]
            count.keep(left)
            if not len(alive):
                return out
    out[:, alive] = ~count.over
    return out


def near_of_pairs(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For pairs of values (words, or rows of words) whether they differ in at most radius bits; 64 pairs are counted in a word."""
    count = Counter((-(-len(a) // 64),), radius)
    for x in planes_of(a ^ b):
        count.add(x)
    return np.unpackbits((~count.over).view(np.uint8), bitorder="little")[: len(a)].astype(bool)


def forest_of_group(values: np.ndarray, block: int = 256) -> np.ndarray:
    """For each value of a group the index of the first value that it is connected to (itself included)."""
    planes, n = planes_of(values), len(values)
    links = np.concatenate([within(planes, values[i : i + block]) for i in range(0, n, block)])
    label = np.arange(n)
    unseen = np.packbits(np.arange(planes.shape[1] * 64) < n, bitorder="little").view(np.uint64)
    lonely = np.bitwise_count(links & unseen).sum(axis=1) <= 1
    for root in np.flatnonzero(~lonely).tolist():
        if not unseen[root // 64] >> np.uint64(root % 64) & np.uint64(1):
            continue
        front = np.array([root])
        while len(front):
            reached = np.bitwise_or.reduce(links[front], axis=0) & unseen
            unseen &= ~reached
            front = np.flatnonzero(np.unpackbits(reached.view(np.uint8), bitorder="little"))
            label[front] = root
    return label


def forest_of_small(values: np.ndarray, group: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same for many small groups at once, sorted by group: the planes are shifted against themselves by each lag."""
    label = np.arange(len(values))
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    rows = np.arange(len(values))
    for lag in range(1, int(size.max(initial=1))):
        rows = rows[size[rows] > lag]
        if len(rows) <= lag:
            break
        a, b = rows[:-lag], rows[lag:]
        same = np.flatnonzero(group[a] == group[b])
        a, b = a[same], b[same]
        if not len(a):
            continue
        near = np.flatnonzero(near_of_pairs(values[a], values[b]))
        pairs.append((a[near], b[near]))
    if pairs:
        a, b = (np.concatenate(x) for x in zip(*pairs))
        while len(a):
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
    return label


def linked(cell: pd.DataFrame) -> pd.DataFrame:
    """Edges (a, b) of a forest over the links among fingerprints of equal key and tile in one cell."""
    cell = cell.drop_duplicates(["key", "tile", "fp"]).sort_values(["key", "tile", "fp"], ignore_index=True)
    values = cell["fp"].to_numpy().view(np.uint64)
    group = cell.groupby(["key", "tile"], sort=False).ngroup().to_numpy()
    size = np.bincount(group)[group] if len(group) else group
    label = np.arange(len(values))
    small = np.flatnonzero(size <= SMALL)
    label[small] = small[forest_of_small(values[small], group[small], size[small])] if len(small) else small
    large = np.flatnonzero(size > SMALL)
    for rows in np.split(large, np.flatnonzero(np.diff(group[large])) + 1) if len(large) else []:
        label[rows] = rows[forest_of_group(values[rows])]
    more = np.flatnonzero(label != np.arange(len(values)))
    return pd.DataFrame({"a": values[more].view(np.int64), "b": values[label[more]].view(np.int64)})


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """docs with fp, the fingerprint's bits as a long."""
    docs = without(docs, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield part.append_column("fp", pa.array(fingerprints(utf8_of(part)).view(np.int64)))

    return docs.mapInArrow(run, with_fields(docs, "fp long"))


def edges_of(distinct: DataFrame, n_distinct: int) -> DataFrame:
    """Forest edges (a, b) that connect all fingerprints (column fp, distinct) within the radius."""
    part = lambda f: F.shiftrightunsigned("fp", f[0]).bitwiseAND((1 << f[1]) - 1)
    pairs = list(itertools.combinations(FIELDS, 2))
    keys = [F.lit(t << 32) + F.shiftleft(part(a), b[1]) + part(b) for t, (a, b) in enumerate(pairs)]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = keyed.join(shared, "key")
    # A hot key's chunks i <= j meet in tile (i, j); other keys are one tile, many of them in a cell.
    chunks = F.ceil(F.col("n") / (HOT // 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    members = members.withColumn("_chunks", chunks).withColumn("_own", own)
    tiles = F.when(F.col("n") <= HOT, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda j: F.least(F.col("_own"), j) * F.col("_chunks") + F.greatest(F.col("_own"), j)))
    tiled = members.select("fp", "key", "n", F.explode(tiles).alias("tile"))
    cells = max(1, len(pairs) * n_distinct // CELL_ROWS)
    cell = F.when(F.col("n") <= HOT, F.pmod(F.xxhash64("key"), F.lit(cells))).otherwise(F.xxhash64("key", "tile"))
    return tiled.select("fp", "key", "tile", cell.alias("cell")).groupBy("cell").applyInPandas(lambda x: linked(x), "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, fingerprint (16 lower-case hex digits) and component_id (smallest doc_id reachable)."""
    marked = materialized(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash-docs")
    distinct = materialized(marked.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-distinct")
    edges = materialized(edges_of(distinct.select("fp"), distinct.count()), "simhash-edges")
    roots = components(edges, "simhash")
    discard(edges)
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Near duplicates by five-word shingles: documents whose sets of shingles have a Jaccard similarity of 0.8 or more are linked;
components are the groups.

Comparison: each set of shingles has a SimHash of 256 bits (a bit is 1 if set in over half of the shingles' hashes). Sets that
may be linked are compared bit-sliced, as in `simhash`, within a radius of 80 bits: at similarity 0.8 the distance is some 40
bits with a deviation of 6, of unrelated sets 128 with a deviation of 8. Pairs within the radius are confirmed by
their exact intersection, unless they are connected already.

Which sets meet: 160 minima of a set (MinHash) in 32 bands of five; sets with an equal band are candidates, and components of
candidates meet in one task, or in tiles of two chunks where a component is large. Of pairs at similarity 0.8 a share of 3e-6
has no equal band by expectation, at 0.9 less than 1e-12. Keys of SimHash fields, as `simhash` uses them for its radius of 3 bits,
cannot do that: a radius of a third of the bits leaves no field of useful width equal. A tile returns a forest instead of pairs.

Equal sets are one node from the start, named by the hash of the set, so exact copies never meet in a comparison. Shingles and
sets are compared as 64-bit hashes.

Defined results: words are lower-case in ASCII letters only; a text of fewer words than a shingle is one shingle; texts that are
null or have no word are one node; rows without doc_id all stay and link no others; of rows of equal doc_id each is judged by
its own text, and of those in one group one stays; repeated rows count as one; an empty table stays empty; columns of any name
pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.bpe import spread
from quillon.llm.common import discard, materialized, pieces, utf8_of
from quillon.llm.components import components
from quillon.llm.simhash import LANES, near_of_pairs, planes_of, within
from quillon.llm.substring import Codes, gram_hashes, mixed

SHINGLE, BANDS, BAND_ROWS, SEED = 5, 32, 5, 42
#: Least similarity of a link, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
#: 64-bit words of a SimHash, and the bits in which two of linked sets differ at most.
LANES_WIDE, WIDE_RADIUS = 4, 80
#: Shingles and sets that a tile aims at, and shingles of the small components that a task takes.
TILE_SHINGLES, TILE_SETS, CELL_SHINGLES = 1_000_000, 4096, 500_000
#: Sets of a group up to which all its pairs are compared side by side with those of other groups, and queries at a time beyond.
SMALL, QUERIES = 32, 256
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, BANDS * BAND_ROWS, np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and how many each text has."""
    words = [x.lower().split() for x in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    grams = gram_hashes(codes(words, int(sizes.sum())), SHINGLE)
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
    whole = place + SHINGLE <= sizes[row]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    alone = np.array([xxhash.xxh3_64_intdigest(b" ".join(words[i])) for i in short], np.uint64)
    row, grams = np.concatenate([row[whole], short]), np.concatenate([grams[whole], alone])
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
    return grams[fresh], np.bincount(row[fresh], minlength=len(words))


def nodes_of(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The node of each set: its hash as a signed long."""
    ends = np.cumsum(sizes)
    return np.array([xxhash.xxh3_64_intdigest(grams[a:b].tobytes()) for a, b in zip((ends - sizes).tolist(), ends.tolist())], np.uint64).view(np.int64)


def bands_of(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sets, BANDS): keys of the bands of each set that is not empty, in order."""
    full = np.flatnonzero(sizes)
    firsts = (np.cumsum(sizes) - sizes)[full]
    out = np.zeros((len(full), BANDS), np.uint64)
    if not len(full):
        return out
    scratch = np.empty_like(grams)
    with np.errstate(over="ignore"):
        for k, factor in enumerate(FACTORS):
            np.multiply(grams, factor, out=scratch)
            band = out[:, k // BAND_ROWS]
            band[:] = mixed(band + np.minimum.reduceat(scratch, firsts) + np.uint64(k + 1))
    return out


def wide_fingerprints(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sets, LANES_WIDE): SimHash of each set over its shingles; zero for an empty one."""
    out = np.zeros((len(sizes), LANES_WIDE), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    # Byte counters hold up to 255 shingles; their sums are added up for each set.
    n = sizes[full]
    parts = -(-n // 255)
    first = np.cumsum(parts) - parts
    heads = np.repeat(np.cumsum(n) - n, parts) + 255 * (np.arange(int(parts.sum())) - np.repeat(first, parts))
    for lane in range(LANES_WIDE):
        with np.errstate(over="ignore"):
            h = mixed(grams * FACTORS[lane] + np.uint64(lane + 1)).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts = np.add.reduceat(np.add.reduceat(LANES[h[:, k]], heads).view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
            ones = np.packbits(2 * counts > n[:, None], axis=1, bitorder="little")[:, 0]
            out[full, lane] |= ones.astype(np.uint64) << np.uint64(8 * k)
    return out


def marked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tie, node, n, bands) of rows (doc_id, tie, text); n counts shingles."""
    codes = Codes()
    for batch in batches:
        for part in pieces(batch, "text"):
            grams, sizes = shingle_sets(utf8_of(part), codes)
            bands = bands_of(grams, sizes).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes > 0)]).astype(np.int32) * BANDS
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tie"), pa.array(nodes_of(grams, sizes)), pa.array(sizes.astype(np.int64)), lists], ["doc_id", "tie", "node", "n", "bands"])


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(root, chunks, node, grams, wide) of candidates."""
    codes = Codes()
    for batch in batches:
        for part in pieces(batch, "text"):
            grams, sizes = shingle_sets(utf8_of(part), codes)
            ends = np.cumsum(sizes)
            sets = pa.array([grams[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist())], pa.binary())
            wide = pa.array([x.tobytes() for x in wide_fingerprints(grams, sizes)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("root"), part.column("chunks"), part.column("node"), sets, wide], ["root", "chunks", "node", "grams", "wide"])


class Sets:
    """Ascending distinct hashes of many sets in one array."""

    def __init__(self, sets: list[bytes]):
        self.sizes = np.array([len(x) // 8 for x in sets], np.int64)
        self.values = np.frombuffer(b"".join(sets), np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def similar(self, one: int, others: np.ndarray) -> np.ndarray:
        """Those of the others that are similar enough to one, by their exact intersections."""
        size, sizes = self.sizes[one], self.sizes[others]
        close = (DENOMINATOR * np.minimum(size, sizes) >= NUMERATOR * np.maximum(size, sizes)) & (sizes > 0)
        others, sizes = others[close], sizes[close]
        if not len(others):
            return others
        own = self.values[self.starts[one] : self.starts[one] + size]
        asked = self.values[spread(self.starts[others], sizes)]
        shared = np.add.reduceat((own[np.minimum(np.searchsorted(own, asked), size - 1)] == asked).astype(np.int64), np.cumsum(sizes) - sizes)
        return others[DENOMINATOR * shared >= NUMERATOR * (size + sizes - shared)]


def forest(sets: Sets, rows: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each of these sets the place (in rows) of the first one that it is connected to, itself included. near: which pairs
    lie within the radius; a pair is confirmed only while its two are not connected yet."""
    label = np.full(len(rows), -1)
    place = {int(r): i for i, r in enumerate(rows)}
    for root in range(len(rows)):
        if label[root] >= 0:
            continue
        label[root], front = root, [root]
        while front:
            one = front.pop()
            asked = np.flatnonzero(near[one] & (label < 0))
            if len(asked):
                more = [place[r] for r in sets.similar(int(rows[one]), rows[asked]).tolist()]
                label[more] = root
                front += more
    return label


def near_matrices(groups: list[np.ndarray], wide: np.ndarray) -> Iterator[np.ndarray]:
    """For each group of sets which of its pairs lie within the radius, as a matrix."""
    small = [(g, rows) for g, rows in enumerate(groups) if len(rows) <= SMALL]
    if small:
        joined = np.concatenate([rows for _, rows in small])
        group = np.repeat(np.arange(len(small)), [len(rows) for _, rows in small])
        first = np.searchsorted(group, np.arange(len(small)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for lag in range(1, max((len(rows) for _, rows in small), default=0)):
        a = np.flatnonzero(group[lag:] == group[:-lag])
        near = a[near_of_pairs(wide[joined[a]], wide[joined[a + lag]], WIDE_RADIUS)]
        found.append((near, near + lag))
    a, b = (np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in (0, 1))
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    number = {g: i for i, (g, _) in enumerate(small)}
    for g, rows in enumerate(groups):
        if g in number:
            start = first[number[g]]
            low, high = np.searchsorted(a, [start, start + len(rows)])
            out = np.zeros((len(rows), len(rows)), bool)
            out[a[low:high] - start, b[low:high] - start] = True
            yield out | out.T
        else:
            planes = planes_of(wide[rows])
            parts = [within(planes, wide[rows[i : i + QUERIES]], radius=WIDE_RADIUS) for i in range(0, len(rows), QUERIES)]
            yield np.unpackbits(np.concatenate(parts).view(np.uint8), axis=1, bitorder="little")[:, : len(rows)].astype(bool)


def confirmed(table: pa.Table) -> pa.Table:
    """Edges (a, b) of a forest over the links in each tile of one cell."""
    root, tile, node = (table.column(c).to_numpy() for c in ("root", "tile", "node"))
    order = np.lexsort((node, tile, root))
    root, tile, node = root[order], tile[order], node[order]
    fresh = np.concatenate([[True], (np.diff(root) != 0) | (np.diff(tile) != 0) | (np.diff(node) != 0)])
    order, root, tile, node = (x[fresh] for x in (order, root, tile, node))
    sets = Sets(table.column("grams").take(pa.array(order)).to_pylist())
    wide = np.frombuffer(b"".join(table.column("wide").take(pa.array(order)).to_pylist()), np.uint64).reshape(-1, LANES_WIDE)
    cuts = np.flatnonzero((np.diff(root) != 0) | (np.diff(tile) != 0)) + 1
    groups = [rows for rows in np.split(np.arange(len(node)), cuts) if len(rows) > 1]
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for rows, near in zip(groups, near_matrices(groups, wide)):
        label = forest(sets, rows, near)
        more = np.flatnonzero(label != np.arange(len(rows)))
        a.append(node[rows[more]])
        b.append(node[rows[label[more]]])
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def star_edges(met: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what (node, low) connects: a node is tied to its least low alone, and so are its other lows.

    Sets of one large group share their lows, so this is about one edge a set instead of one a set and band.
    """
    own = met.groupBy("node").agg(F.min("low").alias("top"), F.collect_set("low").alias("lows"))
    tied = own.select(F.explode(F.array_except(F.array_union("lows", F.array("node")), F.array("top"))).alias("a"), F.col("top").alias("b"))
    return tied.distinct()


def edges_of(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """A table of forest edges (a, b) that connect all linked nodes; distinct: node, n, bands, first (doc_id and tie of one of its rows)."""
    keyed = distinct.select("node", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("band", "key").agg(F.min("node").alias("low"), F.count("*").alias("members")).filter("members > 1").drop("members")
    stars = materialized(star_edges(keyed.join(shared, ["band", "key"]).select("node", "low")), "near-stars")
    roots = components(stars, "near-candidates")
    known = materialized(roots.join(distinct.select("node", "n", "first"), "node"), "near-candidates")
    discard(stars, roots)
    sums = known.groupBy("root").agg(F.sum("n").alias("shingles"), F.count("*").alias("sets"))
    # A large component's chunks i <= j meet in tile (i, j); other components are one tile, many of them in a cell.
    large = (F.col("shingles") > TILE_SHINGLES) | (F.col("sets") > TILE_SETS)
    chunks = F.when(large, F.ceil(F.greatest(2 * F.col("shingles") / TILE_SHINGLES, 2 * F.col("sets") / TILE_SETS))).otherwise(1).cast("int")
    asked = known.join(sums.select("root", chunks.alias("chunks")), "root").select("first.doc_id", "first.tie", "node", "root", "chunks")
    sets = docs.select("doc_id", "tie", "text").join(asked.hint("merge"), ["doc_id", "tie"]).mapInArrow(set_rows, "root long, chunks int, node long, grams binary, wide binary")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.least(F.col("_own"), j) * F.col("chunks") + F.greatest(F.col("_own"), j))
    tiled = sets.withColumn("_own", own).select("root", "node", "grams", "wide", "chunks", F.explode(tiles).alias("tile"))
    cells = (known.agg(F.sum("n")).first()[0] or 0) // CELL_SHINGLES + 1
    cell = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("root"), F.lit(cells))).otherwise(F.xxhash64("root", "tile"))
    edges = materialized(tiled.select("root", "tile", "node", "grams", "wide", cell.alias("cell")).groupBy("cell").applyInArrow(confirmed, "a long, b long"), "near-edges")
    discard(known)
    return edges


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one document of each component, that of the smallest doc_id; documents without doc_id all stay."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", F.xxhash64("text").alias("tie"), "text")
    named = own.filter("doc_id is not null")
    types = dict(docs.dtypes)
    marked = named.select("doc_id", "tie", "text").mapInArrow(marked_rows, f"doc_id {types['doc_id']}, tie long, node long, n long, bands array<long>")
    first = F.min(F.struct("doc_id", "tie")).alias("first")
    distinct = materialized(marked.groupBy("node").agg(first, F.min("n").alias("n"), F.first("bands").alias("bands")), "near-distinct")
    edges = edges_of(named, distinct)
    roots = components(edges, "near")
    discard(edges)
    grouped = distinct.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keepers = grouped.groupBy("root").agg(F.min("first").alias("first")).select("first.*").distinct()
    # What stays follows the documents, so it is never broadcast. Rows of one doc_id and one text are copies; one of them stays.
    kept = named.join(keepers.hint("merge"), ["doc_id", "tie"], "left_semi").dropDuplicates(["doc_id", "tie"])
    return kept.select("_row").unionByName(own.filter("doc_id is null").select("_row")).select("_row.*")

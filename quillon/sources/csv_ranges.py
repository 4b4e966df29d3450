"""CSV whose cells hold line breaks, read in as many tasks as there are byte ranges, with the number of each row.

A line break ends a record only where the number of quotes before it in the file is even. A first pass counts for each range its
quotes, and the records that begin in it for either state that it may be met in; sums over the ranges before it tell which
state holds and what number its first record has. In the second pass each range cuts its own records, reading on into the next
range for the end of its last one, and Spark's own CSV parser takes them apart.

Same rows as Spark's reader of whole files: quotes are doubled within quotes, blank lines are no rows, short rows are filled up
with nulls, and the first record of every file is its header. A record longer than its range is read to its end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range.
RANGE = 32 << 20
#: Records of a batch.
BATCH = 8192
QUOTE, NEWLINE, RETURN = ord('"'), ord("\n"), ord("\r")
PLACES = "number int, file string, start long, end long, size long"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path within it of a file as Spark names it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def outside(data: np.ndarray, quoted: bool) -> np.ndarray:
    """Places of line breaks outside of quotes in bytes whose beginning is within quotes or not."""
    breaks = np.flatnonzero(data == NEWLINE)
    before = np.searchsorted(np.flatnonzero(data == QUOTE), breaks)
    return breaks[(before + quoted) % 2 == 0]


def begins_record(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a record that is not blank begins at these places: not at the end, and not with a line break."""
    padded = np.concatenate([data, np.array([NEWLINE, NEWLINE], np.uint8)])
    first, second = padded[np.minimum(starts, len(data))], padded[np.minimum(starts + 1, len(data) + 1)]
    return (starts < len(data)) & (first != NEWLINE) & ~((first == RETURN) & ((second == NEWLINE) | (starts + 1 == len(data))))


def file_ranges(spark: SparkSession, path: str, size: int = RANGE) -> list[tuple[int, str, int, int, int]]:
    """(number, file, start, end, bytes of the file) of all ranges of a file, or of a folder's files in the order of their names."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    places = [(f, a, min(a + size, n), n) for f, n in sorted((r.path, r.length) for r in files) for a in range(0, n, size)]
    return [(i, *p) for i, p in enumerate(places)]


def _dealt(spark: SparkSession, places: list[tuple], ddl: str) -> DataFrame:
    """One partition for each range."""
    return spark.createDataFrame(places, ddl).repartitionById(max(1, len(places)), F.col("number"))


def count_ranges(spark: SparkSession, places: list[tuple[int, str, int, int, int]]) -> list[tuple[int, str, int, int, int, bool, int]]:
    """places, each with whether it begins within quotes, and the number of its first record in all files, headers included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, name = opened(r["file"])
                with fs.open_input_file(name) as f:
                    data = np.frombuffer(f.read_at(min(r["end"] + 2, r["size"]) - r["start"], r["start"]), np.uint8)
                own = r["end"] - r["start"]
                counts = []
                for quoted in (False, True):
                    breaks = outside(data[:own], quoted)
                    counts.append(int(begins_record(data, breaks + 1).sum()) + int(r["start"] == 0 and begins_record(data, np.zeros(1, np.int64))[0]))
                quotes = int(np.count_nonzero(data[:own] == QUOTE))
                yield pa.RecordBatch.from_pylist([{"number": r["number"], "quotes": quotes, "plain": counts[0], "within": counts[1]}], pa.schema([("number", pa.int32()), ("quotes", pa.int64()), ("plain", pa.int64()), ("within", pa.int64())]))

    if not places:
        return []
    counts = {r.number: r for r in _dealt(spark, places, PLACES).mapInArrow(run, "number int, quotes long, plain long, within long").collect()}
    out, quoted, row = [], False, 0
    for p in places:
        c = counts[p[0]]
        quoted = quoted and p[2] > 0  # a file begins outside of quotes
        out.append((*p, quoted, row))
        row += c.within if quoted else c.plain
        quoted ^= c.quotes % 2 == 1
    return out


def cut_records(f, start: int, end: int, size: int, quoted: bool) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bytes from start on, and begin and end in them of the records that begin in a range (not of blank lines)."""
    data, stop = f.read_at(end - start, start), end
    breaks = outside(np.frombuffer(data, np.uint8), quoted)
    starts = np.concatenate([[0], breaks + 1]) if start == 0 else breaks + 1
    # The last record goes on into what follows.
    step = 1 << 16
    odd = data.count(b'"') % 2 == 1
    while stop < size and len(starts):
        more = f.read_at(min(step, size - stop), stop)
        found = outside(np.frombuffer(more, np.uint8), quoted ^ odd)
        breaks = np.concatenate([breaks, found[:1] + len(data)])
        odd ^= more.count(b'"') % 2 == 1
        data, stop, step = data + more, stop + len(more), 2 * step
        # A record may begin at the very end of the range; its blank line, if it is one, shows in what follows.
        if len(found):
            break
    array = np.frombuffer(data, np.uint8)
    ends = breaks[np.minimum(np.searchsorted(breaks, starts), max(len(breaks) - 1, 0))] if len(breaks) else np.full(len(starts), len(data))
    ends = np.where(ends < starts, len(data), ends)
    keep = begins_record(array, starts)
    starts, ends = starts[keep], ends[keep]
    ends = ends - ((ends > starts) & (array[np.maximum(ends - 1, 0)] == RETURN))
    return data, starts, ends


def texts_between(data: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Parts of UTF-8 bytes as strings."""
    offsets = np.empty(2 * len(starts) + 1, np.int32)
    offsets[0:-1:2], offsets[1:-1:2] = starts, ends
    offsets[-1] = ends[-1] if len(ends) else 0
    parts = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]).take(pa.array(np.arange(0, 2 * len(starts), 2)))
    try:
        return parts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in parts.to_pylist()], pa.string())


def records(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """(text, at) of all records but the first of each file, which is its header: their text, and their number from 0 on."""
    placed = count_ranges(spark, file_ranges(spark, path, size))
    firsts: dict[str, int] = {}
    for _, file, _, _, _, _, first in placed:
        firsts.setdefault(file, first)
    # A file without a record has the first number of the next one, and no header that would count.
    order = [*firsts.values(), placed[-1][6] + 1 if placed else 0]
    skips, n = {}, 0
    for file, a, b in zip(firsts, order, order[1:]):
        n += b > a
        skips[file] = n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                fs, name = opened(r["file"])
                with fs.open_input_file(name) as f:
                    data, starts, ends = cut_records(f, r["start"], r["end"], r["size"], r["quoted"])
                number = r["first"] + np.arange(len(starts))
                body = number != r["head"]
                starts, ends, number = starts[body], ends[body], number[body] - r["skip"]
                for i in range(0, len(starts), BATCH):
                    part = slice(i, i + BATCH)
                    yield pa.RecordBatch.from_arrays([texts_between(data, starts[part], ends[part]), pa.array(number[part])], ["text", "at"])

    dealt = _dealt(spark, [(*p, firsts[p[1]], skips[p[1]]) for p in placed], f"{PLACES}, quoted boolean, first long, head long, skip long")
    return dealt.mapInArrow(run, "text string, at long")


def read_ranges(spark: SparkSession, path: str, columns: list[str], size: int = RANGE) -> DataFrame:
    """These columns of a CSV, or of a folder of CSVs in the order of their names, and the number of each row from 0 on (_at).
    Line breaks within cells are read as \\n."""
    ddl = ", ".join(f"c{i} string" for i in range(len(columns)))
    cells = F.from_csv(F.replace("text", F.lit("\r\n"), F.lit("\n")), ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    own = records(spark, path, size).select(cells.alias("_c"), F.col("at").alias("_at"))
    return own.select(*[F.col(f"_c.c{i}").alias(c) for i, c in enumerate(columns)], "_at")


def readable(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open ranges of these files: not in a store that Spark alone knows."""
    files = spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
    try:
        for f in files:
            opened(f.path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True

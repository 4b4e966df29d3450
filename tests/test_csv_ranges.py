"""CSV by ranges of bytes against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from quillon.sources import csv_ranges, readers

CELLS = ["", "a", "é日", "x,y", 'q"q', "l\nm", "l\r\nm", " sp ", "\n\n", '""', "1", "long " * 9]


def made(rng, rows):
    """A CSV of three columns with short and long rows, blank lines, quotes and line breaks, with either kind of line end."""
    end = rng.choice(["\n", "\r\n"])

    def cell():
        x = rng.choice(CELLS)
        return '"' + x.replace('"', '""') + '"' if rng.random() < 0.3 or any(c in x for c in ',"\n\r') else x

    lines = ["a,b,c"]
    for _ in range(rows):
        lines += [""] * (rng.random() < 0.1)
        lines.append(",".join(cell() for _ in range(rng.choice([3, 3, 3, 2, 4]))))
    return end.join(lines) + end * (rng.random() < 0.5)


def plain(rows, columns):
    """Line breaks in cells are read as they are by Spark, where its own line end is another."""
    return [tuple(None if r[c] is None else r[c].replace("\r\n", "\n") for c in columns) for r in rows]


@pytest.mark.parametrize("seed", range(6))
def test_ranges_equal_whole_files(spark, tmp_path, seed):
    rng = random.Random(seed)
    path = tmp_path / "x.csv"
    path.write_bytes(made(rng, (0, 1, 3, 9, 9, 20)[seed]).encode())
    native = readers.read_csv(spark, str(path))
    want = plain(native.collect(), native.columns)
    for size in (4, 64, 1 << 20):
        got = csv_ranges.read_ranges(spark, str(path), native.columns, size).orderBy("_at").collect()
        assert plain(got, native.columns) == want and [r._at for r in got] == list(range(len(want))), size


def test_folders_and_empty_files(spark, tmp_path):
    for name, text in (("a", 'q,r\n"1\n2",x\n'), ("b", "q,r\n"), ("c", ""), ("d", "\n\nq,r\n\n3,\n\r\n4"), ("e", "q,r\n5,y")):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
    for size in (2, 1000):
        got = csv_ranges.read_ranges(spark, str(tmp_path), ["q", "r"], size).orderBy("_at").collect()
        assert [(r.q, r.r, r._at) for r in got] == [("1\n2", "x", 0), ("3", None, 1), ("4", None, 2), ("5", "y", 3)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    assert csv_ranges.read_ranges(spark, str(tmp_path / "none"), ["q"], 5).count() == 0


def test_bytes_that_are_no_text(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"a,b\n\xff\xfe,2\n")
    assert csv_ranges.read_ranges(spark, str(tmp_path / "x.csv"), ["a", "b"], 3).collect()[0].b == "2"


def test_one_file_in_many_tasks(spark, tmp_path):
    """As many tasks as ranges, and each cuts its own records only."""
    text = "query,n\n" + "".join(f'"line {i}\nand more",{i}\n' for i in range(5000))
    (tmp_path / "x.csv").write_text(text, encoding="utf-8")
    names, rows = readers.numbered_csv(spark, str(tmp_path / "x.csv"), range_bytes=10_000)
    tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == -(-len(text) // 10_000) and max(tasks) < 500 and sum(tasks) == 5000
    assert rows.filter("cast(n as long) <> _at or query <> concat('line ', n, '\nand more')").count() == 0
    samples = readers.scan_samples(spark, str(tmp_path / "x.csv"), 7)
    assert sorted(r.sample_id for r in samples.collect()) == sorted(str(i + 1) for i in range(7))


def test_a_store_that_tasks_cannot_open(spark, tmp_path, monkeypatch):
    """Then files are read whole, with the same rows and numbers."""
    for i in range(2):
        (tmp_path / f"{i}.csv").write_text(f'q\n"{i}\nx"\n{i}b\n', encoding="utf-8")
    by_ranges = readers.numbered_csv(spark, str(tmp_path))[1].orderBy("_at").collect()
    monkeypatch.setattr(readers, "readable", lambda *_: False)
    assert readers.numbered_csv(spark, str(tmp_path))[1].orderBy("_at").collect() == by_ranges

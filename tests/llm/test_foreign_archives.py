"""Archives that others packed: several members, other names, other kinds of records, indexes compressed or missing."""

import gzip
import io
import json
import uuid
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import mixing, warc


def entry(n, payload):
    return warc.record(uuid.UUID(int=n), n, f"http://Www.Example.org:80/a b/{n}", payload, None)


def info():
    block = b"software: other\r\n"
    return b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def packed(parts, compress):
    """Bytes of an archive and the place of each record."""
    data, places = b"", []
    for x in parts:
        own = gzip.compress(x) if compress else x
        places.append((len(data), len(own)))
        data += own
    return data, places


def archive(*, several=True, index="indexes/other-name.cdxj", compress_index=False, plain=False):
    one, two = [info(), entry(1, b"one"), entry(2, b"two" * 9000)], [entry(3, b""), entry(4, b"four")]
    first, second = packed(one, not plain), packed(two, True)
    name = "archive/crawl-1.warc" if plain else "archive/crawl-1.warc.gz"
    lines = [f"org,example)/{i} 20200101000000 " + json.dumps({"offset": str(a), "length": b, "filename": f}) for f, (_, places) in ((name.rpartition("/")[2], first), ("crawl-2.warc.gz", second)) for i, (a, b) in enumerate(places)]
    lines = ["!meta 0 {}", "", *sorted(lines)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}")
        z.writestr(name, first[0])
        if several:
            z.writestr("archive/crawl-2.warc.gz", second[0])
        if index:
            text = "\n".join(lines).encode()
            z.writestr(index, gzip.compress(text[:40]) + gzip.compress(text[40:]) if compress_index else text)
        z.writestr("pages/pages.jsonl", "{}", compress_type=zipfile.ZIP_DEFLATED)
    return pa.BufferReader(out.getvalue())


@pytest.mark.parametrize("how", [{}, {"index": "indexes/index.cdx.gz", "compress_index": True}, {"index": None}, {"plain": True}, {"plain": True, "index": None}])
def test_every_record_of_every_member(how, monkeypatch):
    for fetch in (4 << 20, 100):
        monkeypatch.setattr(warc, "FETCH", fetch)
        rows = [warc.row_of(x) for x in warc.records(archive(**how))]
        assert [(r[0], r[1], r[3]) for r in rows] == [(None, 17, "warcinfo"), (1, 3, "response"), (2, 27000, "response"), (3, 0, "response"), (4, 4, "response")]
        assert rows[1][2] == warc.digest(b"one")


def test_an_archive_that_ends_early():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.warc.gz", gzip.compress(entry(1, b"x" * 999))[:-20])
        z.writestr("b.warc", entry(2, b"y")[:-4])
    with pytest.raises(ValueError, match="within a record"):
        list(warc.records(pa.BufferReader(out.getvalue())))


def test_own_index_is_sorted_cdxj(spark):
    pages = spark.createDataFrame([(i, f"https://b{i % 3}.example.com/x{i}", f"<p>{i}") for i in range(9)] + [(None, None, "")], "page_id long, url string, html string").coalesce(1)
    folder, files = warc.write_archives(pages)
    fs, place = warc.shared_files(folder)
    for f in files.collect():
        with fs.open_input_file(f"{place}/{f.file}") as source:
            at, size = warc.members(source)[warc.INDEX]
            lines = source.read_at(size, at).decode().splitlines()
            assert lines == sorted(lines) and len(lines) == f.n_records
            for line in lines:
                key, when, held = line.split(" ", 2)
                held = json.loads(held)
                assert when == "20000101000000" and {"url", "mime", "status", "digest", "length", "offset", "filename"} <= set(held)
                assert key == (f"com,example,b{held['page_id'] % 3})/x{held['page_id']}" if held["url"] else ")")
    assert warc.read_archives(spark, folder, files).count() == 10


def test_pages_of_one_payload_meet_in_many_slices(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("same").alias("html"))
    got = warc.with_references(pages)
    assert got.filter("refers_to is null").count() == 1 and got.filter("refers_to = 0").count() == 2999
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        each = [r["count"] for r in warc.with_references(pages).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(each) > 1 and max(each) < 2000


def test_rows_without_an_id_spread_over_the_order(spark):
    docs = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    assert docs.select(F.substring(mixing.order_hash(), 1, 2)).distinct().count() > 150

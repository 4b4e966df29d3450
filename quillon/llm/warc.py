"""Web archives packed in ZIP files: written by Spark tasks, and read by byte ranges without extraction.

A task packs its pages in one ZIP file with two stored members: archive/data.warc.gz, whose records are gzip members of their
own, and indexes/index.cdxj, a sorted CDXJ index (turned-round host and path, time, JSON with the record's place). The reader
finds the end record (and its ZIP64 form), parses the central directory, looks up where the members' bytes begin, and takes
every stored archive (.warc, .warc.gz) and index (.cdxj, .cdx, either of them .gz) for what its name says, whatever the archive
was made by. It fetches runs of neighbouring records by range where an index places them; an archive that no index mentions
is read from one end to the other. Records of other kinds than responses and revisits have the size and digest of their block.

Of pages with equal payloads of at least a given size the one with the smallest page_id is a response record; the others are
revisit records that refer to it and hold no payload, only the HTTP header with its length, and its digest. Record ids are
unique; pages are named by a header field of their own (Page-ID), because ids of pages may repeat or be null. A revisit names
the response by its page (Refers-To-Page-ID), target URI and date.

Defined results: a null html is an empty payload; a null url leaves the target URI out; rows with a null page_id refer like
others but are referred to by none, unless no page of that payload has an id (then all are responses); repeated rows that
share the smallest page_id are all responses; an empty table gives no archive and no row; the result has its own columns only.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import materialized, pieces, shared_dir, shared_files, utf8_of

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that are fetched by one range at least, if neighbouring records have as many.
FETCH = 4 << 20
#: Slices of the pages of one payload.
SALTS = 32
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

END, CENTRAL, END64 = struct.Struct("<4s4H2LH"), struct.Struct("<4s6H3L5H2L"), struct.Struct("<4sQ2H2L4Q")
LOCATOR, LOCAL = struct.Struct("<4sLQL"), struct.Struct("<4s5H3L2H")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def numbered(file_id: uuid.UUID, n: int) -> uuid.UUID:
    """The id of record n of a file: that of the file with the number in its last 40 bits."""
    return uuid.UUID(int=file_id.int >> 40 << 40 | n)


def record(record_id: uuid.UUID, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_url: str | None = None) -> bytes:
    """One WARC record; a revisit if it refers to a page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id.urn}>", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if refers_to is not None:
        head += [f"Refers-To-Page-ID: {refers_to}", f"WARC-Refers-To-Date: {DATE}", f"WARC-Profile: {PROFILE}"]
        if refers_url is not None:
            head.append("WARC-Refers-To-Target-URI: " + " ".join(refers_url.split()))
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers of a WARC record (names in lower case), its HTTP header and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    http, _, payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")
    return headers, http, payload


def row_of(data: bytes) -> tuple:
    """What RECORD says of one record; a response's digest and size are those of the payload itself, and a revisit's are stated."""
    headers, http, payload = parsed(data)
    number = lambda name: int(headers[name]) if name in headers else None
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        payload = data.partition(b"\r\n\r\n")[2][: int(headers["content-length"])]
    stated = headers.get("warc-payload-digest", "")
    size, found = len(payload), digest(payload)
    if kind == "revisit":
        size = next((int(x[15:]) for x in http.decode("utf-8", "replace").split("\r\n") if x.lower().startswith("content-length:")), size)
        found = stated.removeprefix("sha1:")
    elif kind == "response" and stated.startswith("sha1:") and stated != f"sha1:{found}":
        raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
    return number("page-id"), size, found, kind, number("refers-to-page-id")


def turned_round(url: str | None) -> str:
    """A URL as an index key: labels of the host from the last to the first, then the path, in lower case."""
    _, _, rest = (url or "").partition("://")
    host, slash, path = rest.partition("/")
    labels = host.partition("@")[2] or host
    return f"{','.join(reversed(labels.partition(':')[0].split('.')))}){slash}{path}".lower().replace(" ", "%20")


def index_line(url: str | None, offset: int, length: int, payload_digest: str, page_id: int | None) -> str:
    """A line of the index, on one record."""
    held = {"url": url, "mime": "text/html", "status": "200", "digest": f"sha1:{payload_digest}", "length": str(length), "offset": str(offset), "filename": ARCHIVE.rpartition("/")[2], "page_id": page_id}
    return f"{turned_round(url)} {''.join(c for c in DATE if c.isdigit())} {json.dumps(held)}"


def members(source) -> dict[str, tuple[int, int]]:
    """Stored members of a ZIP file by name: where their bytes begin, and how many they are."""
    total = source.size()
    tail = source.read_at(min(total, END.size + 0xFFFF), max(0, total - END.size - 0xFFFF))
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) - at < END.size or at + END.size + END.unpack_from(tail, at)[7] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no ZIP file")
    *_, count, size, start, _ = END.unpack_from(tail, at)
    end = total - len(tail) + at
    if end >= LOCATOR.size:
        mark, _, place, _ = LOCATOR.unpack(source.read_at(LOCATOR.size, end - LOCATOR.size))
        if mark == b"PK\x06\x07":
            *_, count, size, start = END64.unpack(source.read_at(END64.size, place))
    directory = source.read_at(size, start)
    out, at = {}, 0
    for _ in range(count):
        mark, _, _, flags, method, _, _, _, packed, full, n_name, n_extra, n_comment, _, _, _, place = CENTRAL.unpack_from(directory, at)
        if mark != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        at += CENTRAL.size
        name = directory[at : at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_comment
        while len(extra) >= 4:
            tag, length = struct.unpack_from("<2H", extra)
            if tag == 1:  # ZIP64: those of the three values, in this order, that did not fit
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                place = next(wide) if place == 0xFFFFFFFF else place
            extra = extra[4 + length :]
        if method == zipfile.ZIP_STORED and not flags & 1:
            own = LOCAL.unpack(source.read_at(LOCAL.size, place))
            if own[0] != b"PK\x03\x04":
                raise ValueError(f"no local header of {name}")
            out[name] = (place + LOCAL.size + own[9] + own[10], packed)
    return out


def index_places(text: str) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of the records that a CDXJ index places; lines on anything else are passed over."""
    for line in text.splitlines():
        start = line.find("{")
        held = json.loads(line[start:]) if start >= 0 and not line.startswith("!") else {}
        if "offset" in held and "length" in held:
            yield str(held.get("filename", "")), int(held["offset"]), int(held["length"])


def unpacked(data: bytes) -> bytes:
    return data if data.startswith(b"WARC/") else zlib.decompress(data, wbits=31)


def in_sequence(source, base: int, size: int) -> Iterator[bytes]:
    """All records of one archive member, read from its beginning to its end."""
    at, end, held, coder = base, base + size, b"", None
    while at < end or held:
        more = source.read_at(min(FETCH, end - at), at) if at < end else b""
        at += len(more)
        held += more
        if held.startswith(b"WARC/"):
            # An archive that is not compressed: a record ends behind its block and two line breaks.
            head = held.find(b"\r\n\r\n")
            n = int(next(x for x in held[:head].lower().split(b"\r\n") if x.startswith(b"content-length:"))[15:]) if head >= 0 else 0
            if head < 0 or len(held) < head + 8 + n:
                if at >= end:
                    raise ValueError("an archive ends within a record")
                continue
            yield held[: head + 8 + n]
            held = held[head + 8 + n :]
            continue
        coder, parts = zlib.decompressobj(wbits=31), []
        while True:
            parts.append(coder.decompress(held))
            held = coder.unused_data
            if coder.eof:
                break
            if at >= end:
                raise ValueError("an archive ends within a record")
            held = source.read_at(min(FETCH, end - at), at)
            at += len(held)
        yield b"".join(parts)


def records(source) -> Iterator[bytes]:
    """All records of all archives in one ZIP file, each archive in the order of its bytes."""
    found = members(source)
    archives = {name: place for name, place in found.items() if name.endswith((".warc", ".warc.gz"))}
    places: dict[str, list[tuple[int, int]]] = {}
    for name, (at, size) in found.items():
        if name.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")):
            data = source.read_at(size, at)
            # A compressed index may be several gzip members.
            for file, offset, length in index_places((gzip.decompress(data) if name.endswith(".gz") else data).decode("utf-8", "replace")):
                places.setdefault(file.rpartition("/")[2], []).append((offset, length))
    for name, (base, size) in sorted(archives.items(), key=lambda x: x[1]):
        own = sorted(set(places.get(name.rpartition("/")[2], [])))
        if not own:
            yield from in_sequence(source, base, size)
        i = 0
        while i < len(own):
            first, j = own[i][0], i
            while j < len(own) and (j == i or sum(own[j]) - first <= FETCH):
                j += 1
            data = source.read_at(max(map(sum, own[i:j])) - first, base + first)
            for offset, length in own[i:j]:
                yield unpacked(data[offset - first :][:length])
            i = j


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, and the response's page_id (refers_to, null for responses) and url (refers_url)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(payload, 256).alias("_key"), F.octet_length(payload).alias("_bytes"))
    # A payload of very many pages meets in SALTS tasks: each of its slices gets a copy of its first page.
    own = own.withColumn("_slice", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("_first")
    slices = own.groupBy("_key", "_slice").agg(least)
    first = slices.groupBy("_key").agg(F.min("_first").alias("_first"), F.collect_set("_slice").alias("_slices"))
    first = first.select("_key", "_first", F.explode("_slices").alias("_slice"))
    refers = (F.col("_bytes") >= least_bytes) & (F.col("_first.page_id") < F.coalesce("page_id", F.lit(2**63 - 1)))
    return own.join(first, ["_key", "_slice"]).select("page_id", "url", "html", F.when(refers, F.col("_first.page_id")).alias("refers_to"), F.when(refers, F.col("_first.url")).alias("refers_url"))


def write_archives(pages: DataFrame, least_bytes: int = 0) -> tuple[str, DataFrame]:
    """ZIP archives of pages (page_id, url, html) below the shared folder: the folder, and the table of its files (file, n_records).
    A retried task writes a file of its own; the table names one each."""
    folder = shared_dir(pages.sparkSession, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, index, at = None, [], 0
        for batch in batches:
            for part in pieces(batch, "html"):
                if out is None:
                    fs, place = shared_files(folder)
                    file_id = uuid.uuid4()
                    name = f"part-{TaskContext.get().partitionId():06d}-{file_id.hex}.zip"
                    out = fs.open_output_stream(f"{place}/{name}")
                    pack = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    member = pack.open(ARCHIVE, "w", force_zip64=True)
                ids, urls, to, to_urls = (part.column(c).to_pylist() for c in ("page_id", "url", "refers_to", "refers_url"))
                for page_id, url, html, refers_to, refers_url in zip(ids, urls, utf8_of(part, "html"), to, to_urls):
                    coder = zlib.compressobj(3, wbits=31)
                    data = coder.compress(record(numbered(file_id, len(index)), page_id, url, html, refers_to, refers_url)) + coder.flush()
                    member.write(data)
                    index.append(index_line(url, at, len(data), digest(html), page_id))
                    at += len(data)
        if out:
            member.close()
            pack.writestr(INDEX, "\n".join(sorted(index)))
            pack.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([len(index)], pa.int64())})

    return folder, materialized(with_references(pages, least_bytes).mapInArrow(run, "file string, n_records long"), "archive-files")


def read_archives(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Every record of these archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                fs, place = shared_files(folder)
                with fs.open_input_file(f"{place}/{file}") as source:
                    rows: list[tuple] = []
                    for data in records(source):
                        rows.append(row_of(data))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    return files.select("file").repartition(max(1, files.count())).mapInArrow(run, RECORD)

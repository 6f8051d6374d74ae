"""WARC archives with a two-level capture index.

Writing: pages become WARC records, one gzip member each. Of records with equal payloads of at least
``LEAST`` bytes the one with the smallest page_id is a response, the others revisit it. Tasks write files
of bounded size under names of their own attempt; only files that a finished task reports count.

Index: one line per capture, keyed by the URL with its host reversed, range-sorted over all tasks by
(key, page_id). Each task writes its range as compressed blocks of ``LINES`` lines and reports
one directory row per block. A lookup goes to the range of its key, finds the block by binary search in the
directory, reads these bytes, and then reads the record's bytes from the archive.

Files go through Arrow's file systems, so the folder may be local, HDFS or an object store. NULL html is an
empty payload; NULL urls have the key ``)``; a NULL page_id is kept. Rows with the same page_id and payload
are all responses or all revisits.
"""

from __future__ import annotations

import bisect
import gzip
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, partitions
from millrace.workspace import run_folder, stored

LEAST = 100
LINES = 256
FILE_BYTES = 64_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """``http://a.b.org/x?q`` as ``org,b,a)/x?q``; lower-case host, no scheme, no fragment."""
    rest = (url or "").partition("://")[2].partition("#")[0]
    at = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    return (",".join(reversed(rest[:at].lower().split("."))) + ")" + rest[at:]).replace("\t", "%09").replace("\n", "%0A").replace("\r", "%0D")


def _name(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe="/:?#[]@!$&'()*+,;=%-._~"),
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": len(payload),
    }
    if page_id is not None:
        head["X-Page-ID"] = page_id
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers_to), "X-Refers-To-Page-ID": refers_to}
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head["Content-Length"] = len(block)
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


CAPTURE = "page_id bigint, url_key string, file string, offset bigint, length bigint"
_capture = pa.schema([("page_id", pa.int64()), ("url_key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns their captures."""
    plain = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    signed = plain.withColumn("digest", F.sha2("html", 256)).withColumn("long", F.octet_length("html") >= least)
    heads, _ = stored(
        signed.where("long").groupBy("digest").agg(F.min("page_id").alias("head"), F.count("*").alias("n")).where("n > 1").select("digest", "head"), "heads"
    )
    revisit = F.col("long") & (F.col("page_id") != F.col("head"))
    marked = signed.join(heads, "digest", "left").withColumn("refers_to", F.when(revisit, F.col("head")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, place = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, digest, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                    if out is None or place >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, place = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = gzip.compress(record(page_id, url, html.encode(), digest, refers), 6, mtime=0)
                    out.write(data)
                    rows.append((page_id, url_key(url), name, place, len(data)))
                    place += len(data)
                if rows:
                    yield batch_of(dict(zip(_capture.names, zip(*rows))), _capture)
        finally:
            if out is not None:
                out.close()

    captures, _ = stored(marked.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, CAPTURE), "captures")
    return captures


DIRECTORY = "index string, key string, page_id bigint, offset bigint, length bigint"
_directory = pa.schema([("index", pa.string()), ("key", pa.string()), ("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index of ``captures`` below ``folder``; returns its directory, one row per block."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, place, held, out = f"index-{uuid.uuid4().hex}.z", 0, [], None

        def flush() -> pa.RecordBatch:
            nonlocal place, held
            data = zlib.compress("\n".join("\t".join(map(str, r)) for r in held).encode())
            out.write(data)
            row = batch_of(dict(zip(_directory.names, ([name], [held[0][0]], [held[0][1]], [place], [len(data)]))), _directory)
            place, held = place + len(data), []
            return row

        try:
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("url_key", "page_id", "file", "offset", "length"))):
                    if out is None:
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    held.append((row[0], NO_ID if row[1] is None else row[1], *row[2:]))
                    if len(held) == LINES:
                        yield flush()
            if held:
                yield flush()
        finally:
            if out is not None:
                out.close()

    ranged = captures.repartitionByRange(partitions(captures), "url_key", F.coalesce("page_id", F.lit(NO_ID)))
    ordered = ranged.sortWithinPartitions("url_key", F.coalesce("page_id", F.lit(NO_ID)))
    directory, _ = stored(ordered.mapInArrow(write, DIRECTORY), "directory")
    return directory


#: Stands for a NULL page_id in the index.
NO_ID = -(1 << 63)


def look_up(spark: SparkSession, wanted: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures of the rows (url_key, page_id) of ``wanted``, one row for each distinct row found."""
    ranges = directory.groupBy("index").agg(F.min(F.struct("key", "page_id")).alias("first")).collect()
    # One row for each index file.
    order = sorted(((r["first"]["key"].encode(), r["first"]["page_id"]), r["index"]) for r in ranges)
    firsts, names = [k for k, _ in order], [n for _, n in order]

    @F.pandas_udf("string")
    def index_of(keys: pd.Series, pages: pd.Series) -> pd.Series:
        spots = (bisect.bisect_right(firsts, (k.encode(), int(p))) - 1 for k, p in zip(keys, pages))
        return pd.Series([names[i] if i >= 0 else None for i in spots], dtype=object)

    asked = wanted.select("url_key", F.coalesce("page_id", F.lit(NO_ID)).alias("page_id")).distinct()
    asked = asked.withColumn("index", index_of("url_key", "page_id")).where("index IS NOT NULL")

    def search(key: tuple, asked: pa.Table, blocks: pa.Table) -> pa.Table:
        store, root = fs.FileSystem.from_uri(folder)
        rows = sorted((k.encode(), p, o, n) for k, p, o, n in zip(*(blocks.column(c).to_pylist() for c in ("key", "page_id", "offset", "length"))))
        starts = [r[:2] for r in rows]
        seen: dict[int, dict] = {}
        out = []
        with store.open_input_file(f"{root}/{key[0].as_py()}") as file:
            for k, p in zip(asked.column("url_key").to_pylist(), asked.column("page_id").to_pylist()):
                # Equal entries may go on from the block before.
                spot = bisect.bisect_right(starts, (k.encode(), p)) - 1
                first = bisect.bisect_left(starts, (k.encode(), p)) - 1
                for i in range(max(first, 0), spot + 1):
                    if i not in seen:
                        lines = zlib.decompress(file.read_at(rows[i][3], rows[i][2])).decode().split("\n")
                        found: dict[tuple, list] = {}
                        for line in lines:
                            u, page, name, offset, length = line.split("\t")
                            found.setdefault((u, int(page)), []).append((name, int(offset), int(length)))
                        seen[i] = found
                    out += [(None if p == NO_ID else p, k, *c) for c in seen[i].get((k, p), [])]
        columns = zip(*out) if out else [[]] * len(_capture)
        return pa.Table.from_batches([batch_of(dict(zip(_capture.names, columns)), _capture)])

    return asked.groupBy("index").cogroup(directory.groupBy("index")).applyInArrow(search, CAPTURE)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to, read from the archives."""
    import hashlib

    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        file, name = None, None
        for batch in batches:
            rows = []
            for wanted, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if wanted != name:
                    if file is not None:
                        file.close()
                    file, name = store.open_input_file(f"{root}/{wanted}"), wanted
                fields, payload = parse(gzip.decompress(file.read_at(length, offset)))
                digest, size = fields["WARC-Payload-Digest"].partition(":")[2], int(fields["X-Payload-Length"])
                if fields["WARC-Type"] == "response":
                    # What is there counts, not what the header says.
                    digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
                page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                rows.append((page and int(page), size, digest, fields["WARC-Type"], refers and int(refers)))
            if rows:
                yield batch_of(dict(zip(schema.names, zip(*rows))), schema)
        if file is not None:
            file.close()

    ordered = captures.repartitionByRange(partitions(captures), "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives with an index, look every page up, and read its record."""
    spark = pages.sparkSession
    folder = run_folder(spark, "warc")
    captures = write_archives(pages, folder)
    directory = write_index(captures, folder)
    return read_records(look_up(spark, captures, directory, folder), folder)

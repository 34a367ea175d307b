"""WARC archives with a two-level capture index.

Writing: pages of equal payloads (SHA-1 and length) are found by a grouping; every task
writes one archive of gzip members and returns a capture for each record.  The captures
are range-partitioned and sorted by reversed-host key; every part is a file of compressed
blocks of lines with a sparse directory (each block's first key and place) beside it.

Reading: a key is searched in the first keys of the parts, then in the part's directory,
then in the one block read for it; the capture found there gives the byte range of the
record.  Lookups are dealt out by part, and a part's records are read in file order.

Files go through ``pyarrow.fs`` under the shared folder.  A task that is run again writes
files of new names, and only what a finished task returned is referred to.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import materialise, new_folder

BLOCK_LINES = 1024
NO_ID = -(1 << 63)
CAPTURES = "surt string, id long, file string, at long, length long"
PARTS = "first_surt string, first_id long, file string, directory string"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
DATE = "2024-01-01T00:00:00Z"


def surt(url: Column) -> Column:
    """Sort key of a URL: its host's labels reversed, then the rest; a null URL is empty."""
    u = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rest = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), rest)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _record(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes) -> bytes:
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size)), ("Content-Type", "text/html")]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=~%-._")))
        head.append(("X-Url", json.dumps(url)))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", str(refers_to))]
    body = payload if refers_to is None else b""
    text = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(body)))])
    return b"WARC/1.1\r\n" + text.encode() + b"\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = dict(x.split(": ", 1) for x in lines)
    return headers, rest[: int(headers["Content-Length"])]


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 1000,
                   folder: str | None = None) -> tuple[str, DataFrame]:
    """Write one record per page; the folder and its captures (``surt, id, file, at, length``).

    Of equal payloads (UTF-8; null: empty) of ``least_bytes`` or more, those of the largest
    id are responses and the others revisit it; smaller payloads are all responses.  Rows
    without an id are responses.  Repeated rows give records of their own.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    latest = rows.where((F.col("size") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("digest", "size").agg(
        F.max("page_id").alias("latest"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(latest, ["digest", "size"], "left").select(
        "page_id", "url", "digest", "size", F.when(F.col("page_id") != F.col("latest"), F.col("latest")).alias("refers_to"), "payload",
        surt(F.col("url")).alias("surt"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _open(folder)
        system.create_dir(f"{top}/archive", recursive=True)
        path, out, at, captures = "", None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{folder}/archive/{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(f"{top}/archive/{path.rsplit('/', 1)[1]}", compression=None)
                member = _gzip(_record(row["page_id"], row["url"], row["digest"], row["size"], row["refers_to"], row["payload"]))
                out.write(member)
                captures.append((row["surt"], NO_ID if row["page_id"] is None else row["page_id"], path, at, len(member)))
                at += len(member)
        if out is not None:
            out.close()
        names = ["surt", "id", "file", "at", "length"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([c[k] for c in captures], t) for k, t in enumerate(kinds)], names)

    return folder, materialise(rows.mapInArrow(write, CAPTURES), "captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sort the captures into parts of compressed blocks; one row per part (``PARTS``)."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _open(folder)
        system.create_dir(f"{top}/index", recursive=True)
        name = uuid.uuid4().hex
        out, at, lines, directory = None, 0, [], []

        def flush() -> None:
            nonlocal at, lines
            block = _gzip("\n".join(json.dumps(x) for x in lines).encode())
            out.write(block)
            directory.append([lines[0][0], lines[0][1], at, len(block)])
            at, lines = at + len(block), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = system.open_output_stream(f"{top}/index/{name}.idx", compression=None)
                lines.append(row)
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        out.close()
        with system.open_output_stream(f"{top}/index/{name}.dir", compression=None) as f:
            f.write(_gzip(json.dumps(directory).encode()))
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (directory[0][0], directory[0][1], f"{folder}/index/{name}.idx", f"{folder}/index/{name}.dir")],
                                         ["first_surt", "first_id", "file", "directory"])

    ordered = captures.repartitionByRange(parts, "surt", "id").sortWithinPartitions("surt", "id")
    return materialise(ordered.mapInArrow(write, PARTS), "index-parts")


def _read(uri: str, at: int | None = None, length: int | None = None) -> bytes:
    system, path = _open(uri)
    with system.open_input_file(path) as f:
        return f.read() if at is None else f.read_at(length, at)


def look_up(keys: DataFrame, parts: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records (``RECORDS``) of the captures whose (``surt``, ``id``) is in ``keys``; unknown keys give no row.

    ``parts`` has one row per index part (as many as shuffle partitions); they are
    collected and broadcast.  Repeated keys count once; repeated captures are all read.
    """
    spark = keys.sparkSession
    table = sorted((r["first_surt"], r["first_id"], r["file"], r["directory"]) for r in parts.collect())
    shared = spark.sparkContext.broadcast(table)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = [x[:2] for x in shared.value]
        for batch in batches:
            where = [(max(bisect.bisect_left(first, k) - 1, 0), max(bisect.bisect_right(first, k) - 1, 0))
                     for k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            row = [i for i, (a, b) in enumerate(where) for _ in range(a, b + 1)]  # a repeated key may go on in the next part
            part = [p for a, b in where for p in range(a, b + 1)]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row, pa.int64())) for c in batch.columns), pa.array(part, pa.int32())], ["surt", "id", "part"])

    def read(key: tuple, group: pa.Table) -> pa.Table:
        _, _, file, directory = shared.value[key[0].as_py()]
        blocks = json.loads(zlib.decompress(_read(directory), 31))
        first = [(b[0], b[1]) for b in blocks]
        wanted: dict[int, list] = {}
        for k in set(zip(group["surt"].to_pylist(), group["id"].to_pylist(), strict=True)):
            for b in range(max(bisect.bisect_left(first, k) - 1, 0), bisect.bisect_right(first, k)):
                wanted.setdefault(b, []).append(k)
        captures = []
        system, path = _open(file)
        with system.open_input_file(path) as f:
            for b in sorted(wanted):
                lines = [json.loads(x) for x in zlib.decompress(f.read_at(blocks[b][3], blocks[b][2]), 31).split(b"\n")]
                order = [(x[0], x[1]) for x in lines]
                for k in wanted[b]:
                    captures += lines[bisect.bisect_left(order, k) : bisect.bisect_right(order, k)]
        captures.sort(key=lambda c: (c[2], c[3]))
        out: dict[str, list] = {c.split()[0]: [] for c in RECORDS.split(", ")}
        opened, handle = None, None
        for _, _, archive, at, length in captures:
            if archive != opened:
                if handle:
                    handle.close()
                system, path = _open(archive)
                opened, handle = archive, system.open_input_file(path)
            h, payload = parse_record(handle.read_at(length, at))
            revisit = h["WARC-Type"] == "revisit"
            out["page_id"].append(int(h["X-Page-Id"]) if "X-Page-Id" in h else None)
            out["url"].append(json.loads(h["X-Url"]) if "X-Url" in h else None)
            out["record_type"].append(h["WARC-Type"])
            out["refers_to"].append(int(h["X-Refers-To-Page"]) if revisit else None)
            # A revisit has no payload of its own; its headers describe the one it refers to.
            out["payload_bytes"].append(int(h["X-Payload-Length"]) if revisit else len(payload))
            out["payload_digest"].append(h["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest())
            out["payload"].append(payload if with_payload and not revisit else None)
        if handle:
            handle.close()
        kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})

    if not table:
        return spark.createDataFrame([], RECORDS)
    return keys.select("surt", "id").mapInArrow(assign, "surt string, id long, part int").groupBy("part").applyInArrow(read, RECORDS)


def page_keys(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The index keys of pages."""
    return pages.select(surt(F.col(url_col)).alias("surt"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"))

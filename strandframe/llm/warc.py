"""WARC archives with a two-level capture index.

Records are gzip members of ``.warc.gz`` files. Captures are sorted by reversed-host URL
key and cut into compressed blocks; a directory holds the first and last key of each
block. A lookup searches the directory, opens only the blocks it names, and reads the
records by file, offset and length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, scratch, written

#: Compressed bytes after which a writer begins a new file.
FILE_BYTES = 256 << 20
#: Captures in a block at least, and blocks in the directory at most (about).
BLOCK_LINES, MOST_BLOCKS = 3000, 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: str | None) -> str:
    """Reversed host, port and path: ``com,example,blog)/a?b``. Scheme, user, a leading ``www.``, a default port and the fragment go; upper case goes in the host."""
    url = _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", (url or "").strip())
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return f")/{url}"
    host = host[4:] if host.startswith("www.") else host
    place = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    return f"{','.join(reversed(host.split('.')))}{place}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def capture_key(key: str, page_id: int | None) -> str:
    """A capture's sort key: its URL key, a space, and the page id so written that text order is number order."""
    return f"{key} {(page_id if page_id is not None else -(1 << 63)) + (1 << 63):020d}"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP head only and names the page that it repeats."""
    kind = "response" if refers_to is None else "revisit"
    target = _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url or "urn:none")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {target} {digest}')}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        *([f"X-Page-Id: {page_id}"] if page_id is not None else []),
        *([f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"] if refers_to is not None else []),
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(data: bytes) -> dict:
    """Fields of a record: type, page_id, refers_to, url, digest as written, and the payload (none in a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    own = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(own["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record of another length")
    number = lambda k: int(own[k]) if k in own else None
    payload = block.partition(b"\r\n\r\n")[2] if own["WARC-Type"] == "response" else None
    return {"type": own["WARC-Type"], "page_id": number("X-Page-Id"), "refers_to": number("X-Refers-To-Page-Id"), "url": own["WARC-Target-URI"], "digest": own["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": payload}


def classified(pages: DataFrame, least_bytes: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(id, url, html, sha, refers_to)``: refers_to is the largest id with an equal payload, null where that is the row itself."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("size"))
    best = rows.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.max("id").alias("best"), F.count("*").alias("n")).where("n > 1")
    joined = join_hot(rows, best.select("sha", "best"), "sha")  # copies of one payload stay where they are
    return joined.select("id", "url", "html", "sha", F.when(F.col("id").isNull() | (F.col("best") != F.col("id")), F.col("best")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the records below ``folder`` and returns a written table of captures ``(ckey, file, offset, length)``.

    A file's name is unique to the attempt that writes it, and only the captures of
    attempts that succeed are kept: files of lost or repeated tasks are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for i, url, html, sha, refers in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html", "sha", "refers_to"))):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                data = gzip.compress(record(i, url, html.encode("utf-8", "surrogatepass"), digest, refers), 4, mtime=0)
                out.write(data)
                rows.append((capture_key(url_key(url), i), name, at, len(data)))
                at += len(data)
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["ckey", "file", "offset", "length"])
        if out is not None:
            out.close()

    return written(records.mapInArrow(run, "ckey string, file string, offset long, length long"), "captures")


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """A written table of blocks ``(block, first, last, lines, data)``: sorted captures, compressed.

    Blocks hold more lines where there are many captures, so that the directory keeps
    about MOST_BLOCKS entries. Keys hold the page id, so one URL may fill many blocks.
    """
    size = max(block_lines, -(-captures.count() // MOST_BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names = ["first", "last", "lines", "data"]

        def block(rows: list[tuple]) -> pa.RecordBatch:
            lines = "\n".join("\t".join(map(str, r)) for r in rows)
            cols = [[rows[0][0]], [rows[-1][0]], [len(rows)], [zlib.compress(lines.encode("utf-8", "surrogatepass"), 6)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.binary()))], names)

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= size:
                yield block(held[:size])
                held = held[size:]
        if held:
            yield block(held)

    ordered = captures.select("ckey", "file", "offset", "length").repartitionByRange("ckey").sortWithinPartitions("ckey", "file", "offset")
    blocks = ordered.mapInArrow(run, "first string, last string, lines long, data binary")
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def directory(index: DataFrame) -> tuple[list[str], list[str], list[int]]:
    """First keys, last keys and block numbers, sorted; its size is bounded by ``build_index``."""
    rows = sorted((r["first"].encode("utf-8", "surrogatepass"), r["last"].encode("utf-8", "surrogatepass"), r["block"]) for r in index.select("first", "last", "block").collect())
    return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Captures ``(ckey, file, offset, length)`` for the keys in ``wanted (ckey)``; keys that are not there give no row.

    The directory is searched for each key, and only blocks that may hold one are opened.
    """
    firsts, lasts, numbers = directory(index)
    shared = index.sparkSession.sparkContext.broadcast((firsts, lasts, numbers))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, number = shared.value
        for b in batches:
            found = set()
            for k in b.column("ckey").to_pylist():
                k = k.encode("utf-8", "surrogatepass")
                found.update(range(bisect_left(last, k), bisect_right(first, k)))
            yield pa.RecordBatch.from_arrays([pa.array([number[i] for i in found], pa.int64())], ["block"])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("data").to_pylist():
                lines = [x.split("\t") for x in zlib.decompress(data).decode("utf-8", "surrogatepass").split("\n")]
                k, f, o, n = zip(*lines)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(f), pa.array(map(int, o), pa.int64()), pa.array(map(int, n), pa.int64())], ["ckey", "file", "offset", "length"])

    keys = wanted.where(F.col("ckey").isNotNull()).select("ckey").distinct()
    hit = keys.mapInArrow(named, "block long").distinct()
    lines = index.join(hit, "block", "left_semi").select("data").mapInArrow(opened, "ckey string, file string, offset long, length long")
    return lines.join(keys, "ckey", "left_semi")


def read_captures(captures: DataFrame, folder: str) -> DataFrame:
    """``(page_id, type, refers_to, url, digest, payload_digest, payload_bytes, html)`` of the records at the captures' places."""
    names = ["page_id", "type", "refers_to", "url", "digest", "payload_digest", "payload_bytes", "html"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            held, weight = [], 0
            for f, o, n in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if f != name:
                    if source is not None:
                        source.close()
                    name, source = f, store.open_input_file(f"{root}/{f}")
                r = read_record(gzip.decompress(source.read_at(n, o)))
                p = r["payload"]
                held.append((r["page_id"], r["type"], r["refers_to"], r["url"], r["digest"], None if p is None else _digest(p), None if p is None else len(p), None if p is None else p.decode("utf-8", "surrogatepass")))
                weight += len(p or b"")
                if weight > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                    held, weight = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
        if source is not None:
            source.close()

    spread = captures.repartition("file", F.expr(f"offset div {FILE_BYTES // 32}")).sortWithinPartitions("file", "offset")
    return spread.mapInArrow(run, "page_id long, type string, refers_to long, url string, digest string, payload_digest string, payload_bytes long, html string")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every row, written to archives, found by the index and read back.

    Of rows with equal payloads the one with the largest id is the response (all that
    share this id are), the others revisit it; payloads under ``least_bytes`` are
    responses each, as are rows of a group without any id. A revisit's payload is that of
    the record it refers to. Null html is the empty payload, a null url has the key of an
    empty one. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    captures = write_archives(classified(pages, least_bytes, id_col, url_col, html_col), folder)
    index = build_index(captures)
    wanted = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [capture_key(url_key(u), i) for i, u in zip(b.column("id").to_pylist(), b.column("url").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["ckey"])

    found = read_captures(lookup(index, wanted.mapInArrow(keyed, "ckey string")), folder).drop("html", "url")
    found = written(found.withColumn("ref", F.concat_ws(" ", F.coalesce("refers_to", "page_id").cast("string"), "digest")), "records")
    payloads = found.where("type = 'response'").groupBy("ref").agg(F.max("payload_bytes").alias("full_bytes"), F.max("payload_digest").alias("full_digest"))
    whole = join_hot(found, payloads, "ref")
    return whole.select("page_id", F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")

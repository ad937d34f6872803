"""Interleaved document sequences: ordered text and media references parsed from HTML, media resolved by digest.

Media are kept losslessly as 8-bit grey PNG images of 64 samples a row.
"""

from __future__ import annotations

import hashlib
import html
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, join_hot, written

WIDTH = 64
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_BLOCKS = frozenset("address article aside blockquote body div dd dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul br".split())
_MEDIA = frozenset("img video audio source".split())
_HIDDEN = frozenset("script style template noscript title".split())


def padded(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes of a text with zeros up to a positive multiple of WIDTH, and the number of bytes without them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(max(1, -(-len(raw) // WIDTH)) * WIDTH - len(raw)), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: bytes) -> bytes:
    """An image with a sample for each byte; rows are stored unfiltered."""
    rows = np.frombuffer(samples, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 4)) + _chunk(b"IEND", b"")


def decode_png(image: bytes) -> bytes:
    """The samples of an image that ``encode_png`` has made; anything else is an error."""
    if image[:8] != _SIGNATURE:
        raise ValueError("no PNG signature")
    at, data, size = 8, b"", None
    while at < len(image):
        (n,) = struct.unpack_from(">I", image, at)
        kind, body = image[at + 4 : at + 8], image[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", image, at + 8 + n)[0]:
            raise ValueError("a chunk's checksum differs")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    if size is None or size[0] != WIDTH or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey image of this width")
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size[1], WIDTH + 1)
    if lines[:, 0].any():
        raise ValueError("a filtered row")
    return lines[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Average hash of an 8 x 8 reduction of the samples in order, then their mean in hundredths: 16 hex digits, ``-``, 5 digits."""
    a = np.frombuffer(samples, np.uint8).astype(np.int64)
    sums = np.r_[0, np.cumsum(a)]
    cuts = len(a) * np.arange(65) // 64
    means = np.diff(sums[cuts]) / np.diff(cuts)
    bits = np.packbits(means > means.mean()).tobytes().hex()
    return f"{bits}-{int(100 * a.sum() // len(a)):05d}"


class _Sequence(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.text: list[str] = []
        self.hidden = 0
        self.figure: int | None = None
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text.clear()
        if text:
            self.items.append({"position": len(self.items), "kind": "text", "text": text, "ref": None, "caption": None})

    def handle_starttag(self, tag, attrs):
        if tag in _HIDDEN:
            self.hidden += 1
        elif tag == "figcaption":
            self.flush()
            self.caption = []
        elif tag in _MEDIA:
            own = dict(attrs)
            if own.get("src"):
                self.flush()
                self.items.append({"position": len(self.items), "kind": "media", "text": None, "ref": own["src"], "caption": own.get("alt") or None})
        elif tag in _BLOCKS:
            self.flush()
            if tag == "figure":
                self.figure = len(self.items)

    def handle_endtag(self, tag):
        if tag in _HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "figcaption" and self.caption is not None:
            text = " ".join("".join(self.caption).split())
            for item in self.items[self.figure or 0 :] if self.figure is not None else []:
                if item["kind"] == "media":
                    item["caption"] = text or item["caption"]
            self.caption = None
        elif tag in _BLOCKS:
            if tag == "figure":
                self.figure, self.caption = None, None
            self.flush()

    def handle_data(self, data):
        if not self.hidden:
            (self.text if self.caption is None else self.caption).append(data)


def parse(page: str | None) -> list[dict]:
    """Ordered items ``position, kind (text or media), text, ref, caption`` of a page.

    Text is cut at block elements and at media, with white space folded; scripts, styles
    and titles are left out. A figure's caption goes to the media in it, else the
    alternative text is the caption. Null and empty pages have no item.
    """
    parser = _Sequence()
    parser.feed(page or "")
    parser.close()
    parser.flush()
    return parser.items


ITEMS = "array<struct<position:int,kind:string,text:string,ref:string,caption:string>>"
_ITEM = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())]))


def sequences(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(id, items)`` for every row; other columns are not read."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([parse(t) for t in b.column("html").to_pylist()], _ITEM)], ["id", "items"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, items {ITEMS}")


def resolve(refs: DataFrame, media: DataFrame) -> DataFrame:
    """``refs`` (with ``ref``, a digest) and the columns of ``media (ref, ...)``, one row for a digest; unknown digests get nulls.

    A digest that many rows refer to is joined by broadcast, see ``join_hot``.
    """
    return join_hot(refs, media, "ref")


def page_of(text: str, ref: str, size: int) -> str:
    """A page with a text's lines as paragraphs and one figure after the first."""
    first, *rest = text.split("\n")
    figure = f'<figure><img src="{ref}" alt=""><figcaption>text of {size} bytes</figcaption></figure>'
    return "<article>" + "".join([f"<p>{html.escape(first, False)}</p>", figure, *(f"<p>{html.escape(x, False)}</p>" for x in rest)]) + "</article>"


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table ``(id, n_bytes, position, items, caption, ref, media)``: each text's page and its image.

    ``ref`` is ``sha256:`` and the digest of the image; position and caption are those of
    its reference in the parsed page. A task keeps an image once for a batch of rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "n_bytes", "position", "items", "caption", "ref", "media"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 4 << 20):
            out, seen = [], {}
            for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                text = text or ""
                row = seen.get(text)
                if row is None:
                    payload, n = padded(text)
                    image = encode_png(payload)
                    ref = f"sha256:{hashlib.sha256(image).hexdigest()}"
                    items = parse(page_of(text, ref, n))
                    own = next(x for x in items if x["ref"] == ref)
                    seen[text] = row = (n, own["position"], len(items), own["caption"], ref)
                    out.append((i, *row, image))
                else:
                    out.append((i, *row, None))
            types = [b.schema.field("id").type, pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    kind = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"id {kind}, n_bytes long, position int, items int, caption string, ref string, media binary"), "media")


def facts(stored: DataFrame) -> DataFrame:
    """``(ref, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature)`` of each stored image, read back."""
    names = ["ref", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "media", 4 << 20):
            out = []
            for ref, image in zip(b.column("ref").to_pylist(), b.column("media").to_pylist()):
                samples = decode_png(image)
                out.append((ref, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-WIDTH:]), len(image), hashlib.sha256(image).hexdigest(), feature(samples)))
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    found = stored.where(F.col("media").isNotNull()).select("ref", "media").mapInArrow(run, "ref string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return found.groupBy("ref").agg(*[F.max(c).alias(c) for c in names[1:]])


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text stored as an image in a page, the page's reference resolved and the image read back.

    Null texts count as empty: 64 zero samples. Repeated rows each keep their row. Other
    columns are not read.
    """
    stored = store(docs, id_col, text_col)
    return resolve(stored.drop("media"), written(facts(stored), "facts"))

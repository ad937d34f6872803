"""Packing token pieces into fixed-length sequences: first-fit decreasing on a tournament tree."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, sums_before, written

#: Pieces in a group that is packed on its own, about.
GROUP_PIECES = 4096

#: Characters outside ASCII and Latin letters, numbers that are no digits, and separators that engines class differently.
_OTHER = re.compile("[^\t\n\r -~¡-§©«°±»¿-ɏ–—‘-„…€]")
_SPACES = re.compile("[\t\n\r ][\t\n\r ]")
_CUT = re.compile("(?<=[\t\n\r ])(?=[\t\n\r ][^\t\n\r ])")
_WORD = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


class Encoder:
    """Ids of a byte-level BPE file, as little-endian unsigned 32-bit bytes.

    The merges are done by the faster of the two libraries that know this vocabulary.
    Of white space before a word, the file's pre-tokenizer leaves the last character to
    the word; texts are cut there first, so that its pattern needs no look-ahead. Texts
    with characters beyond the plain ones, or with a special token in them, go to the
    file's own tokenizer.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ids = self.tokenizer.get_vocab(with_added_tokens=False)
        # the file writes each byte as a character: printable ones as themselves, the others from U+0100 on
        letters = set(ByteLevel.alphabet())
        plain = {c for c in map(chr, range(256)) if c in letters}
        byte = {c: ord(c) for c in plain} | dict(zip(sorted(letters - plain), (b for b in range(256) if chr(b) not in plain)))
        ranks = {bytes(byte[c] for c in token): k for token, k in ids.items() if token not in self.special}
        self.merge = tiktoken.Encoding("ids", pat_str=_WORD, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, texts: list[str]) -> list[bytes]:
        return list(map(self.one, texts))

    def one(self, text: str) -> bytes:
        if _OTHER.search(text) or any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if _SPACES.search(text):
            return b"".join(array("I", self.merge(part)).tobytes() for part in _CUT.split(text))
        return array("I", self.merge(text)).tobytes()


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", place: Column | None = None) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens)``: each document's ids and ``end_id``, cut into pieces of at most ``capacity``.

    Null texts count as empty: one piece that holds ``end_id`` alone. Other columns are
    not read, save that ``place`` (a struct of longs) goes with the pieces.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *([] if place is None else [place.alias("place")]))
    more = rows.columns[2:]
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = Encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for b in chunks(batches, "text"):
            row, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(encode(b.column("text").to_pylist())):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(ids) // 4)
            cols = [b.column("id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            cols += [b.column(c).take(pa.array(row, pa.int64())) for c in more]
            yield pa.RecordBatch.from_arrays(cols, ["id", "start", "length", "ids_crc32", "doc_tokens", *more])

    kinds = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in more)
    return rows.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long{kinds}")


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; ``sizes`` must fall. A tournament tree over the bins holds the largest room below each node."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room, bins, offsets = [capacity] * (2 * leaves), [], []
    for size in sizes:
        if size > room[1]:
            raise ValueError(f"an item of {size} exceeds the capacity {capacity}")
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def _stretches(rows: DataFrame, group_pieces: int) -> DataFrame:
    """``rows`` and ``__group``: consecutive stretches of ``group_pieces`` rows in the order of ``place``, a struct that begins with ``slot``."""
    rows = rows.withColumn("__slot", F.col("place.slot"))
    before = sums_before(written(rows.groupBy("__slot").count(), "slots"), [], "__slot", "count", "__before").drop("count")
    rank = F.row_number().over(Window.partitionBy("__slot").orderBy("place", "id", "start", "__row")) - 1
    ranked = rows.withColumn("__rank", rank).join(before, "__slot")
    return ranked.withColumn("__group", F.expr(f"(__before + __rank) div {group_pieces}"))


def pack(parts: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``parts`` (with ``length`` of 1 to ``capacity``) and their ``sequence_id`` and ``offset``.

    Pieces are dealt to random groups by row, so no document, source or repeated row
    can fill one. If they have a ``place``, groups are consecutive stretches of that order
    instead, and ``sequence_id`` rises with them. Each group is packed on its own; a
    sequence's pieces are gapless from 0.
    """
    rows = written(parts.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    kept = [f for f in parts.schema.fields if f.name != "place"]
    names = [f.name for f in kept]

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("__row", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), capacity)
        base = table.column("__group")[0].as_py() << 32
        out = table.select(names).append_column("sequence_id", pa.array([base + b for b in bins], pa.int64()))
        return out.append_column("offset", pa.array(offsets, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    if "place" in parts.columns:
        dealt = _stretches(rows, group_pieces).select(*names, "__row", "__group")
    else:
        groups = max(1, -(-rows.count() // group_pieces))
        dealt = rows.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    return dealt.groupBy("__group").applyInArrow(fill, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", place: Column | None = None) -> DataFrame:
    """All documents as pieces in sequences; see ``pieces`` and ``pack``."""
    return pack(pieces(docs, tokenizer_path, capacity, 1, id_col, text_col, place), capacity)

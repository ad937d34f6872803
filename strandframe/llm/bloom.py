"""Blocked Bloom filters built in tasks: one bit in each of the eight words of a 256-bit block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for a key, blocks that a task writes as one row, and bytes of all filters of a broadcast at most.
KEY_BITS, ROW_BLOCKS, MOST_BYTES = 16, 1 << 12, 1 << 26
_GOLD = 0x9E3779B97F4A7C15
#: Odd multipliers of the words, each from the golden ratio's multiples.
_ODD = np.array([(_GOLD * (2 * k + 1) >> 7) & 0xFFFFFFFF | 1 for k in range(8)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of ``x`` (unsigned 64-bit)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _bit(h: np.ndarray, word: int) -> np.ndarray:
    low = (h & np.uint64(0xFFFFFFFF)) * _ODD[word] & np.uint64(0xFFFFFFFF)
    return np.uint32(1) << (low >> np.uint64(27)).astype(np.uint32)


def contains(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter, ``(blocks, 8)`` of unsigned 32-bit words."""
    at = np.arange(len(h))
    if not len(table):
        return np.zeros(len(h), bool)
    block = block_of(h, len(table))
    for word in range(8):
        hit = (table[block, word] & _bit(h[at], word)) != 0
        at, block = at[hit], block[hit]
    out = np.zeros(len(h), bool)
    out[at] = True
    return out


def sizes(keys: dict[int, int], most_bytes: int = MOST_BYTES) -> dict[int, int]:
    """Blocks of each shard's filter for its number of keys; together they take at most ``most_bytes`` and a block a shard."""
    whole = {s: -(-n * KEY_BITS // 256) for s, n in keys.items()}
    share = min(1.0, most_bytes / max(1, 32 * sum(whole.values())))
    return {s: max(1, int(b * share)) for s, b in whole.items()}


def build(hashes: DataFrame, blocks: dict[int, int]) -> dict[int, np.ndarray]:
    """Filters by shard of ``hashes (shard int, h long)`` on the driver: as many bytes as ``blocks`` says, however many keys."""
    size = F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv]) if blocks else F.lit(None)
    if not blocks:
        return {}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, n = b.column("h").to_numpy().view(np.uint64), b.column("blocks").to_numpy().astype(np.uint64)
            block = ((h >> np.uint64(32)) * n >> np.uint64(32)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("shard"), pa.array(block // ROW_BLOCKS), pa.array(block % ROW_BLOCKS), b.column("h")], ["shard", "part", "block", "h"])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table = None, None
        row = lambda: pa.RecordBatch.from_pydict({"shard": pa.array([now[0]], pa.int32()), "part": pa.array([now[1]], pa.int64()), "bits": pa.array([table.tobytes()], pa.binary())})
        for b in batches:
            shard, part, block, h = (b.column(c).to_numpy() for c in ("shard", "part", "block", "h"))
            cuts = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (part[1:] != part[:-1])]) if len(shard) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(shard)]):
                if (key := (int(shard[lo]), int(part[lo]))) != now:
                    if now is not None:
                        yield row()
                    now, table = key, np.zeros((ROW_BLOCKS, 8), np.uint32)
                for word in range(8):
                    np.bitwise_or.at(table[:, word], block[lo:hi], _bit(h[lo:hi].view(np.uint64), word))
        if now is not None:
            yield row()

    dealt = hashes.withColumn("blocks", size[F.col("shard")].cast("long")).mapInArrow(placed, "shard int, part long, block long, h long")
    rows = dealt.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(filled, "shard int, part long, bits binary")
    out = {s: np.zeros((-(-n // ROW_BLOCKS) * ROW_BLOCKS, 8), np.uint32) for s, n in blocks.items()}
    for r in rows.collect():
        out[r["shard"]][r["part"] * ROW_BLOCKS : (r["part"] + 1) * ROW_BLOCKS] = np.frombuffer(r["bits"], np.uint32).reshape(-1, 8)
    return {s: t[: blocks[s]] for s, t in out.items()}

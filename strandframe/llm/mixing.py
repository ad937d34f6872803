"""Mixing sources to target weights by Pfair scheduling.

A source's text is a row of blocks of equal size. With weight w, its block j (from 1) is
released at floor((j - 1) / w) and due at ceil(j / w); in each slot the released block
with the earliest deadline runs. Every block then meets its window, so what a source has
got never differs from its share by a whole block.
"""

from __future__ import annotations

import heapq
from array import array
from dataclasses import dataclass
from fractions import Fraction
from math import lcm

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import positional, sums_before, written

#: Bytes of a block, slots in a period of the schedule, and sources at most.
BLOCK_BYTES, PERIOD, MOST_SOURCES = 1 << 16, 4096, 1024
#: Blocks at most: beyond, blocks grow instead, so the schedule has a size that does not grow with the text (8 bytes a block, and 4096 slots for each source that ends).
MOST_BLOCKS = 1 << 21
#: Rows of a source whose sizes are summed in one go, about.
PART_ROWS = 1024


def quanta(weights: dict[str, float], period: int) -> dict[str, int]:
    """Slots of a period for each source: shares rounded by the largest remainders, one at least. The plan does not round."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    k = 0
    while (gap := period - sum(out.values())) != 0:
        s = by_rest[k % len(by_rest)]
        if gap > 0:
            out[s] += 1
        else:
            s = max(out, key=lambda s: (out[s] - exact[s], s))
            out[s] -= 1
        k += 1
    return out


def windows(j: np.ndarray, n, period) -> tuple[np.ndarray, np.ndarray]:
    """Release and deadline of block j (from 0) of a source with n slots in a period."""
    return j * period // n, -(-(j + 1) * period // n)


def schedule(weights: dict[str, int], slots: int) -> dict[str, np.ndarray]:
    """Slots of each source's blocks among the first ``slots``, the earliest deadline first (ties: the source's name)."""
    total = sum(weights.values())
    out = {s: array("q") for s in weights}
    later, ready = [(0, s, 0) for s in weights], []
    heapq.heapify(later)
    for t in range(slots):
        while later and later[0][0] <= t:
            _, s, j = heapq.heappop(later)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[s]), s, j))
        if ready:
            _, s, j = heapq.heappop(ready)
            out[s].append(t)
            heapq.heappush(later, ((j + 1) * total // weights[s], s, j + 1))
    return {s: np.frombuffer(at, np.int64) if at else np.zeros(0, np.int64) for s, at in out.items()}


def period_slots(shares: dict[str, int], period: int) -> dict[str, np.ndarray]:
    """Slots of each source's blocks in one period with whole shares that fill it."""
    return schedule(shares, period)


@dataclass
class Phase:
    """A stretch of the schedule in which the same sources take part: its first slot, and their first blocks, exact shares of a period, whole-number weights and slots."""

    start: int
    first: dict[str, int]
    shares: dict[str, Fraction]
    weights: dict[str, int]
    slots: dict[str, np.ndarray]


def plan(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[Phase]:
    """Phases until every source is used up; a source that ends leaves its weight to the others, in proportion.

    Every block is placed by the exact weights (floats taken as the fractions they are).
    A phase lasts whole periods, and one more in which sources may end; what is left of
    them fills their first slots there, and the slots after their end stay empty.
    """
    phases, left, start = [], {s: n for s, n in blocks.items() if n > 0}, 0
    exact = {s: Fraction(weights[s]) for s in left}
    unit = lcm(*(w.denominator for w in exact.values()))
    while left:
        whole = {s: int(exact[s] * unit) for s in left}
        total = sum(whole.values())
        shares = {s: Fraction(w * period, total) for s, w in whole.items()}
        rounds = min(-(-left[s] // shares[s]) for s in left)
        slots = schedule(whole, rounds * period)
        phases.append(Phase(start, {s: blocks[s] - left[s] for s in left}, shares, whole, slots))
        start += rounds * period
        left = {s: n - len(slots[s]) for s, n in left.items() if n > len(slots[s])}
    return phases


def mix(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_bytes: int = BLOCK_BYTES, period: int = PERIOD) -> DataFrame:
    """``docs`` and ``block``, ``release``, ``deadline``, ``slot``, ``block_offset``; no row is left out or repeated.

    A row takes its UTF-8 bytes and one more of its source's blocks, in an order mixed by
    a hash of the id; it runs where its first byte lies. Order by ``slot``,
    ``block_offset`` to read the mix. ``weights`` (default: the square root of each
    source's size) must name every source, with positive values; null is the source
    ``""``. Input columns with the names of new ones are replaced. Sources number
    MOST_SOURCES at most. Windows count from the start of a source's phase. A text of over
    MOST_BLOCKS blocks in all has blocks of a MOST_BLOCKSth of its bytes instead.
    """
    new = ["block", "release", "deadline", "slot", "block_offset"]
    kept = [c for c in docs.columns if c not in new]
    own = positional(docs)
    named = dict(zip(docs.columns, own.columns))
    text = F.col(named[text_col])
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = own.select(*[named[c] for c in kept], F.coalesce(F.col(named[source_col]).cast("string"), F.lit("")).alias("source"), size.alias("size"), F.xxhash64(F.col(named[id_col]), text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    parts = -(-max(1, docs.count()) // PART_ROWS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("hash", "row"), F.lit(parts)))
    sums = written(rows.groupBy("source", "part").agg(F.sum("size").alias("bytes")), "sizes")
    totals = {r["source"]: r["bytes"] for r in sums.groupBy("source").agg(F.sum("bytes").alias("bytes")).limit(MOST_SOURCES + 1).collect()}
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    block_bytes = max(block_bytes, -(-sum(totals.values()) // MOST_BLOCKS))
    if weights is None:
        weights = {s: n**0.5 for s, n in totals.items()}
    if bad := [s for s in totals if not weights.get(s, 0) > 0]:
        raise ValueError(f"sources without a positive weight: {bad[:5]}")
    phases = plan({s: -(-n // block_bytes) for s, n in totals.items()}, weights, period)
    own = {s: [p for p in phases if s in p.weights] for s in totals}
    table = {s: (np.array([p.first[s] for p in x]), np.array([p.start for p in x]), [(sum(p.weights.values()), p.weights[s]) for p in x], [p.slots[s] for p in x]) for s, x in own.items()}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("release long, deadline long, slot long")
    def scheduled(source: pd.Series, block: pd.Series) -> pd.DataFrame:
        out = np.zeros((3, len(block)), np.int64)
        for s, at in source.groupby(source).indices.items():
            first, start, weights, slots = shared.value[s]
            j = block.to_numpy()[at]
            k = np.searchsorted(first, j, "right") - 1
            j = j - first[k]
            for i, (x, y) in enumerate(zip(k.tolist(), j.tolist())):
                total, w = weights[x]
                out[0, at[i]], out[1, at[i]] = y * total // w, -(-(y + 1) * total // w)
                out[2, at[i]] = start[x] + slots[x][y]
        return pd.DataFrame(out.T, columns=["release", "deadline", "slot"])

    before = sums_before(sums, ["source"], "part", "bytes", "before").drop("bytes")
    inner = F.sum("size").over(Window.partitionBy("source", "part").orderBy("hash", "row").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rows.withColumn("inner", inner).join(before, ["source", "part"]).withColumn("at", F.col("before") + F.col("inner"))
    placed = placed.withColumn("block", F.expr(f"at div {block_bytes}")).withColumn("times", scheduled("source", "block"))
    out = placed.select(*[named[c] for c in kept], "block", "times.release", "times.deadline", "times.slot", F.col("at") % block_bytes)
    return out.toDF(*kept, *new)


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """All rows of ``docs`` with their own columns, dealt to files by slot and sorted there: reading the files in order reads the mix."""
    own = positional(docs)
    named = dict(zip(docs.columns, own.columns))
    mixed = mix(own, id_col=named[id_col], text_col=named[text_col], source_col=named[source_col], **options)
    mixed = mixed.repartitionByRange("slot", "block_offset").sortWithinPartitions("slot", "block_offset")
    return mixed.select(*own.columns).toDF(*docs.columns)

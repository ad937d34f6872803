"""Near duplicates by SimHash with deletion-variant signatures.

A fingerprint of ``64 * lanes`` bits is cut into so few segments that, within the
radius, one segment differs by one bit at most. Every segment is indexed once for
each of its bits with that bit left out, so two such segments share a variant.
Fingerprints meet by equality of variants and are verified on all their bits. Where
texts are linked by the similarity of their shingle sets, fingerprints find candidates
and the sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, join_hot, large_star_small_star, written

#: Fingerprints that one task compares at a time, about.
BUCKET_ROWS = 1 << 18
#: Groups of a variant up to this size are compared by shifting; larger ones by breadth-first search.
SMALL_GROUP = 24
#: Links by similarity: words of 64 bits in a fingerprint, its segments, and the bits in which candidates differ at most.
LANES, SEGMENTS, RADIUS = 3, 12, 40
#: Shingles in a block of candidates that one task compares with another block.
BLOCK_SHINGLES = 1 << 16
#: Pairs that read one copy of a text.
HUB_PAIRS = 256


def _mix(h: np.ndarray, lane: int) -> np.ndarray:
    """Other 64 bits from a hash (the finaliser of splitmix64)."""
    x = h + np.uint64((lane * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle: ASCII lower case, words cut at ASCII white space, joined by a space."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, "<u8")
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, seed)], "<u8")
    at = np.cumsum([0, *map(len, parts)]) + np.arange(len(parts) + 1)
    return np.array([digest(joined[i : j - 1], seed) for i, j in zip(at[:-words].tolist(), at[words:].tolist())], "<u8")


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> bytes:
    """A bit is 1 if it is set in over half the hashes; least significant byte first. No hash: all zero."""
    if not len(hashes):
        return bytes(8 * lanes)
    out = []
    for lane in range(lanes):
        h = hashes if lane == 0 else _mix(hashes, lane)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(h), 4096):
            ones += np.unpackbits(h[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(np.packbits(2 * ones > len(h), bitorder="little").tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, lanes: int = 1) -> DataFrame:
    """``(id, fp binary)`` for every row; other columns are not read. Null and empty texts: all bits zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 4 << 20):
            fps = [fingerprint(shingle_hashes(t.as_py(), words), lanes) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps, pa.binary())], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp binary")


def _segment(a: np.ndarray, lo: int, width: int) -> np.ndarray:
    lane, shift = divmod(lo, 64)
    seg = a[:, lane] >> np.uint64(shift)
    if shift + width > 64:
        seg = seg | (a[:, lane + 1] << np.uint64(64 - shift))
    return seg & np.uint64((1 << width) - 1)


def _variant(a: np.ndarray, lo: int, width: int, bit: int) -> np.ndarray:
    """The segment with one bit left out."""
    seg = _segment(a, lo, width)
    return ((seg >> np.uint64(bit + 1)) << np.uint64(bit)) | (seg & np.uint64((1 << bit) - 1))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _spanning(a: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Edges that span the components of a large group: each visited row is compared only with rows not yet reached."""
    left, right, open_rows = [], [], np.arange(len(a))
    while len(open_rows):
        front, open_rows = [int(open_rows[0])], open_rows[1:]
        while front and len(open_rows):
            at = front.pop()
            near = _distance(a[open_rows], a[at]) <= radius
            found = open_rows[near].tolist()
            left += [at] * len(found)
            right += found
            front += found
            open_rows = open_rows[~near]
    return left, right


def _first_meeting(a: np.ndarray, b: np.ndarray, cuts: list[int], segment: int, bit: int) -> np.ndarray:
    """Whether this variant is the first that the pairs share: no earlier segment differs by one bit or none, and equal segments meet at bit 0."""
    x = a ^ b
    first = (bit == 0) | (_segment(x, cuts[segment], cuts[segment + 1] - cuts[segment]) != 0)
    for k in range(segment):
        first &= np.bitwise_count(_segment(x, cuts[k], cuts[k + 1] - cuts[k])) > 1
    return first


def _bucket_pairs(a: np.ndarray, cuts: list[int], segment: int, bit: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of the fingerprints of one bucket: of a small group all that meet here first, of a large one those that span its components."""
    key = _variant(a, cuts[segment], cuts[segment + 1] - cuts[segment], bit)
    order = np.argsort(key, kind="stable")
    a, key = a[order], key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
    sizes = np.diff(np.r_[starts, len(key)])
    left, right = [np.empty(0, int)], [np.empty(0, int)]
    for s, n in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
        i, j = _spanning(a[s : s + n], radius)
        left.append(np.array(i, int) + s)
        right.append(np.array(j, int) + s)
    size = np.repeat(sizes, sizes)
    rank = np.arange(len(key)) - np.repeat(starts, sizes)
    for step in range(1, min(SMALL_GROUP, int(sizes.max(initial=0)))):
        i = np.flatnonzero((size <= SMALL_GROUP) & (rank + step < size))
        i = i[_distance(a[i], a[i + step]) <= radius]
        i = i[_first_meeting(a[i], a[i + step], cuts, segment, bit)]
        left.append(i)
        right.append(i + step)
    return a[np.concatenate(left)], a[np.concatenate(right)]


def _bucket_links(a: np.ndarray, cuts: list[int], segment: int, bit: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of one bucket that link, each with the first of those it is connected with here."""
    x, y = _bucket_pairs(a, cuts, segment, bit, radius)
    both, at = np.unique(np.concatenate([x, y]), axis=0, return_inverse=True)
    i, j, label = at[: len(x)], at[len(x) :], np.arange(len(both))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(both)))
    return both[moved], both[label[moved]]


def links(nodes: DataFrame, radius: int, segments: int, lanes: int = 1, bucket_rows: int = BUCKET_ROWS, pairs: bool = False) -> DataFrame:
    """Edges ``(a, b)`` that connect the fingerprints in ``nodes (fp)``, which are distinct, as their links do.

    All links of at most ``2 * segments - 1`` differing bits are found; of links with
    more (up to ``radius``) those with a segment of at most one differing bit. Of one
    variant's group only edges that span its components are emitted. ``pairs``: every
    edge is a link itself, emitted once, where its ends meet first, and of groups of up
    to SMALL_GROUP all links are emitted.
    """
    bits = 64 * lanes
    cuts = [bits * k // segments for k in range(segments + 1)]
    variants = [(k, bit) for k in range(segments) for bit in range(cuts[k + 1] - cuts[k])]
    split = 1
    total = nodes.count()
    while split * bucket_rows < total:
        split *= 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = np.frombuffer(b"".join(batch.column("fp").to_pylist()), "<u8").reshape(-1, lanes)
            where, blocks = [], []
            for v, (k, bit) in enumerate(variants):
                part = _mix(_variant(a, cuts[k], cuts[k + 1] - cuts[k], bit), 1) % np.uint64(split) if split > 1 else None
                for s in range(split):
                    rows = a if part is None else a[part == s]
                    if len(rows):
                        where.append(v * split + s)
                        blocks.append(rows.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(blocks, pa.binary())], ["bucket", "block"])

    def compare(table: pa.Table) -> pa.Table:
        segment, bit = variants[table.column("bucket")[0].as_py() // split]
        a = np.frombuffer(b"".join(table.column("block").to_pylist()), "<u8").reshape(-1, lanes)
        x, y = (_bucket_pairs if pairs else _bucket_links)(a, cuts, segment, bit, radius)
        if pairs:  # a pair that met before is connected by what was emitted there
            first = _first_meeting(x, y, cuts, segment, bit)
            x, y = x[first], y[first]
        return pa.table({"a": pa.array([r.tobytes() for r in x], pa.binary()), "b": pa.array([r.tobytes() for r in y], pa.binary())})

    return nodes.select("fp").mapInArrow(spread, "bucket long, block binary").groupBy("bucket").applyInArrow(compare, "a binary, b binary")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4, segments: int = 3, lanes: int = 1) -> DataFrame:
    """``(id, fp, component)`` for every row: component is the smallest id reachable over links, its own included.

    Rows with equal fingerprints are linked. Repeated rows and ids each keep their row.
    A component whose ids are all null has a null component. Null and empty texts have
    the fingerprint zero and are linked like any other.
    """
    own = written(fingerprints(docs, id_col, text_col, words, lanes), "fingerprints")
    nodes = written(own.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    cc = large_star_small_star(links(nodes, radius, segments, lanes))
    cc = cc.unionByName(cc.select(F.col("b").alias("a"), "b").distinct())
    member = written(cc.join(nodes, F.col("a") == F.col("fp")).select("fp", "b", "least"), "members")
    best = member.groupBy("b").agg(F.min("least").alias("component"))
    of = nodes.join(join_hot(member, best, "b").select("fp", "component", F.lit(True).alias("linked")), "fp", "left")
    of = of.select("fp", F.when(F.col("linked"), F.col("component")).otherwise(F.col("least")).alias("component"))
    return join_hot(own, of, "fp")


def jaccard_reaches(a: np.ndarray, b: np.ndarray, similarity: Fraction) -> bool:
    """Whether the Jaccard similarity of two sorted sets of hashes is ``similarity`` or more; empty sets equal each other."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * similarity.denominator >= similarity.numerator * (len(a) + len(b) - common)


def _node(shingles: np.ndarray) -> int:
    """63 bits that stand for a sorted set of hashes."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) >> 1


def _verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The ``pairs (a, b)`` of nodes whose ``sets (node, shingles)`` have the similarity, written.

    The pairs of a node are dealt to parts of about HUB_PAIRS; each part reads the node's
    set once, before those of its partners.
    """
    hubs = pairs.groupBy("a").agg(F.expr(f"(count(*) - 1) div {HUB_PAIRS}").alias("parts"))
    parted = join_hot(pairs, hubs.where("parts > 0"), "a").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(0)) + 1).alias("part"))
    firsts = hubs.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), "parts")).alias("part")).join(sets, "node")
    partners = parted.select("a", "part", F.col("b").alias("node")).join(sets, "node")
    rows = firsts.select(F.col("node").alias("a"), "part", F.lit(None).cast("long").alias("b"), "shingles").unionByName(partners.select("a", "part", F.col("node").alias("b"), "shingles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, np.empty(0, "<u8")
        for batch in batches:
            out = []
            for a, part, b, s in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "b", "shingles"))):
                if b is None:
                    last, own = (a, part), np.frombuffer(s, "<u8")
                elif last == (a, part) and jaccard_reaches(own, np.frombuffer(s, "<u8"), similarity):
                    out.append((a, b))
            x, y = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    placed = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return written(placed.mapInArrow(run, "a long, b long"), "links")


def spanning_links(sets: list[np.ndarray], parts: list[int], similarity: Fraction) -> tuple[list[int], list[int]]:
    """Links between sets of different parts (each taken as connected) that, with the parts, connect what all links connect.

    A set that has been reached is compared with the sets not yet reached only, through
    an index of shingle numbers.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    values, at = np.unique(np.concatenate(sets) if sets else np.empty(0, "<u8"), return_inverse=True)
    ends = np.cumsum(sizes)
    part = np.unique(np.array(parts), return_inverse=True)[1]
    members: dict[int, list[int]] = {}
    for k, p in enumerate(part.tolist()):
        members.setdefault(p, []).append(k)
    mark = np.zeros(len(values), bool)
    left, right, unreached = [], [], np.arange(len(sets))
    while len(unreached):
        front = list(members[part[unreached[0]]])
        unreached = unreached[part[unreached] != part[unreached[0]]]
        while front and len(unreached):
            k = front.pop()
            low, high = np.minimum(sizes[unreached], sizes[k]), np.maximum(sizes[unreached], sizes[k])
            near = unreached[(low * similarity.denominator >= high * similarity.numerator) & (low > 0)]
            if not len(near):
                continue
            own = at[ends[k] - sizes[k] : ends[k]]
            mark[own] = True
            size = sizes[near]
            begin = np.cumsum(size) - size
            places = np.arange(size.sum()) + np.repeat(ends[near] - size - begin, size)
            common = np.add.reduceat(mark[at[places]].astype(np.int64), begin)
            mark[own] = False
            found = near[common * similarity.denominator >= similarity.numerator * (size + sizes[k] - common)]
            for j in found.tolist():
                left.append(k)
                right.append(j)
            if len(found):
                new = np.unique(part[found])
                front += [m for p in new.tolist() for m in members[p]]
                unreached = unreached[~np.isin(part[unreached], new)]
    return left, right


def _connected(nodes: DataFrame, sets: DataFrame, similarity: Fraction, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links ``(a, b)`` that finish the groups of ``nodes (node, grp, part, size)``: with the parts they connect what all links in a group connect.

    Groups are dealt to blocks of about ``block_shingles`` shingles, and every two blocks
    of a group meet in a task, save two that hold nodes of the group's largest part only.
    """
    sizes = nodes.groupBy("grp", "part").agg(F.sum(F.col("size") + 1).alias("shingles"))
    main = sizes.groupBy("grp").agg(F.max_by("part", "shingles").alias("main"), F.max("shingles").alias("inside"), (F.sum("shingles") - F.max("shingles")).alias("outside"))
    blocks = lambda c: F.expr(f"({c} + {block_shingles} - 1) div {block_shingles}")
    main = main.where("outside > 0").select("grp", "main", blocks("inside").alias("ni"), blocks("outside").alias("no"))
    one = (F.col("ni") + F.col("no") == 2) & F.lit(True)
    hashed = F.xxhash64("node")
    placed = nodes.join(main, "grp").withColumn("block", F.when(F.col("part") == F.col("main"), F.pmod(hashed, F.col("ni"))).otherwise(F.col("ni") + F.pmod(hashed, F.col("no"))))
    all_of = F.sequence(F.lit(0).cast("long"), F.col("ni") + F.col("no") - 1)
    others = F.when(F.col("block") < F.col("ni"), F.sequence(F.col("ni"), F.col("ni") + F.col("no") - 1)).otherwise(all_of)
    placed = placed.withColumn("other", F.explode(F.when(one, F.array(F.lit(1).cast("long"))).otherwise(others)))
    low, high = F.when(one, 0).otherwise(F.least("block", "other")), F.when(one, 1).otherwise(F.greatest("block", "other"))
    dealt = placed.select("node", "grp", "part", low.alias("low"), high.alias("high")).join(sets, "node")

    def run(table: pa.Table) -> pa.Table:
        names = table.column("node").to_pylist()
        x, y = spanning_links([np.frombuffer(s, "<u8") for s in table.column("shingles").to_pylist()], table.column("part").to_pylist(), similarity)
        return pa.table({"a": pa.array([names[k] for k in x], pa.int64()), "b": pa.array([names[k] for k in y], pa.int64())})

    return written(dealt.groupBy("grp", "low", "high").applyInArrow(run, "a long, b long"), "more")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns kept.

    Texts are linked if the Jaccard similarity of their shingles is ``similarity`` or
    more; no link is made without that test. Fingerprints of the shingle sets, met by
    deletion variants, find what is tested: sets whose fingerprints differ in RADIUS bits
    at most and share a variant (certain up to ``2 * SEGMENTS - 1`` bits, likely beyond).
    In a group that such candidates connect and the tested ones do not, all pairs that
    are not connected are tested. The row with the smallest id stays (then the smallest
    hash of its text; rows that repeat both stay once). Documents without a word are a
    group like any other. Rows with a null id stay only if no row of the group has an id.
    """
    digest = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(id_col), F.lit(0)))
    marks = {"__digest": digest, "__id": F.coalesce(F.col(id_col), F.lit(0)), "__none": F.col(id_col).isNull()}
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), digest.alias("digest"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 4 << 20):
            sets = [np.unique(shingle_hashes(t.as_py(), words)) for t in b.column("text")]
            arrays = [b.column("id"), pa.array(map(_node, sets), pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array([fingerprint(s, LANES) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "node", "size", "fp"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 4 << 20):
            sets = [np.unique(shingle_hashes(t.as_py(), words)).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])

    rows = docs.select(key.alias("id"), F.col(text_col).alias("text"))
    own = written(rows.mapInArrow(describe, f"id {rows.schema['id'].dataType.simpleString()}, node long, size long, fp binary"), "sets")
    nodes = written(own.groupBy("node").agg(F.min("id").alias("least"), F.first("size").alias("size"), F.first("fp").alias("fp")), "nodes")
    # of nodes with one fingerprint the least stands for it, and is a candidate with the others
    fps = written(nodes.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    met = links(fps, RADIUS, SEGMENTS, LANES, pairs=True).distinct()
    met = met.join(fps.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a").join(fps.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    same = join_hot(nodes.select("node", "fp"), fps.withColumnRenamed("node", "first"), "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    pairs = written(met.unionByName(same).distinct(), "candidates")

    # the shingle sets of the nodes in candidate pairs
    wanted = nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    wanted = wanted.select("node", F.col("least.digest").alias("__digest"), F.coalesce("least.id", F.lit(0)).alias("__id"), F.col("least.none").alias("__none"))
    texts = docs.withColumns(marks).select("__digest", "__id", "__none", F.col(text_col).alias("text")).join(wanted, ["__digest", "__id", "__none"])
    sets = written(texts.select("node", "text").mapInArrow(read, "node long, shingles binary").dropDuplicates(["node"]), "shingles")
    found = _verified(pairs, sets, similarity)
    cc = large_star_small_star(found)

    # groups of candidates that the links do not connect
    coarse = large_star_small_star(pairs)
    inside = nodes.join(coarse.select(F.col("a").alias("node"), F.col("b").alias("grp")), "node", "left").join(cc.select(F.col("a").alias("node"), F.col("b").alias("part")), "node", "left")
    inside = written(inside.select("node", "size", F.coalesce("grp", "node").alias("grp"), F.coalesce("part", "node").alias("part")), "groups")
    still = inside.groupBy("grp").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n")).where("low <> high and n > 2").select("grp")
    more = _connected(join_hot(inside, still.withColumn("open", F.lit(True)), "grp").where("open").drop("open"), sets, similarity)
    cc = large_star_small_star(cc.unionByName(more))

    stays = nodes.join(cc, F.col("node") == F.col("a"), "left").groupBy(F.coalesce("b", "node").alias("part")).agg(F.min("least").alias("least"))
    stays = stays.select(F.col("least.digest").alias("__digest"), F.coalesce("least.id", F.lit(0)).alias("__id"), F.col("least.none").alias("__none"))
    found = docs.withColumns(marks)
    twice = written(own.groupBy("id").count().where("count > 1").select(F.col("id.digest").alias("__digest")).distinct(), "repeats")
    kept = found.join(stays, ["__digest", "__id", "__none"], "left_semi")
    single = kept.join(twice, "__digest", "left_anti")
    repeated = kept.join(twice, "__digest", "left_semi").dropDuplicates(["__digest", "__id", "__none"])
    return single.unionByName(repeated).select(*docs.columns)

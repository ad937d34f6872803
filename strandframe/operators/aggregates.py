"""Aggregates over index statistics, reads and call sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import intervals


def ploidy(idxstats: DataFrame, autosomes: list[str], contigs: list[str] | None = None) -> DataFrame:
    """``(ctg, normalized_coverage, ploidy)`` from ``(ctg, length, mapped)`` of one or more inputs.

    Mapped reads are summed over inputs; coverage is twice the rate over the autosomes'
    rate. Values in the gaps between the bins are ``Unknown``.
    """
    per = idxstats.where(F.col("ctg").isin(contigs)) if contigs else idxstats
    per = per.groupBy("ctg").agg(F.max("length").alias("length"), F.sum("mapped").alias("mapped")).where("length > 0")
    auto = per.where(F.col("ctg").isin(autosomes)).agg((F.sum("mapped") / F.sum("length")).alias("__rate"))
    x = per.crossJoin(F.broadcast(auto)).withColumn("normalized_coverage", F.col("mapped") / F.col("length") / F.when(F.col("__rate") != 0, F.col("__rate")) * 2)
    c = F.col("normalized_coverage")
    name = F.when(c < 0.4, "0").when((c > 0.6) & (c < 1.4), "1").when((c > 1.6) & (c < 2.4), "2").when((c > 2.6) & (c < 3.4), "3").when(c > 3.4, "3+").otherwise("Unknown")
    return x.select("ctg", "normalized_coverage", name.alias("ploidy"))


def sex(ploidies: DataFrame, x: str = "chrX", y: str = "chrY") -> DataFrame:
    """One row ``sex``: male (X 1, Y 1), female (X 2, Y 0), else Unknown; absent contigs are Unknown too."""
    of = lambda c: F.max(F.when(F.col("ctg") == c, F.col("ploidy")))
    both = ploidies.agg(of(x).alias("x"), of(y).alias("y"))
    return both.select(F.when((F.col("x") == "1") & (F.col("y") == "1"), "male").when((F.col("x") == "2") & (F.col("y") == "0"), "female").otherwise("Unknown").alias("sex"))


def sum_rules(rows: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """Aggregates each field by the function named for it: sum, max, min or avg."""
    known = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}
    return rows.groupBy(*keys).agg(*[known[how](field).alias(field) for field, how in rules.items()])


def combine_stats(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(status).count()


def mean_read_length(reads: DataFrame, n: int = 100_000, default: float = 151.0) -> DataFrame:
    """Average length of the first ``n`` reads; ``default`` if there is none."""
    return reads.select("seq").limit(n).agg(F.coalesce(F.avg(F.length("seq")), F.lit(default)).alias("read_length"))


def canonical(kmer: Column) -> Column:
    """The smaller of a sequence and its reverse complement."""
    return F.least(kmer, F.reverse(F.translate(kmer, "ACGT", "TGCA")))


#: Bases that a task cuts at a time; k-mers of a bucket, on average, and those that a task counts at a time.
PACK_BASES, BUCKET_KMERS, COUNT_KMERS = 1 << 20, 1 << 21, 1 << 22
_CODES = np.full(256, 255, np.uint8)
_CODES[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
_QUADS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8)


def _packed(code: np.ndarray, k: int) -> np.ndarray:
    """Canonical k-mers of codes 0 to 3, two bits a base; so packed, number order is text order. Longer ones are put together from two shorter ones."""
    n = len(code) - k + 1
    there = back = None
    have, part = 0, 1
    own, other = code.astype(np.int64), 3 - code.astype(np.int64)
    while True:
        if k & part:
            there = own[:n] if there is None else (there << (2 * part)) | own[have : have + n]
            back = other[:n] if back is None else back | (other[have : have + n] << (2 * have))
            have += part
        if have == k:
            return np.minimum(there, back)
        own, other = (own[:-part] << (2 * part)) | own[part:], other[:-part] | (other[part:] << (2 * part))
        part *= 2


def _cut(code: np.ndarray, k: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """The k-mers of A, C, G and T (codes 0 to 3) as stretches of bases, those of a bucket together: their number, their lengths, and their bases, two bits each.

    The bucket of a k-mer is told by the least hash of its canonical m-mers, which its
    reverse complement has too; neighbours share it mostly, so a stretch holds several.
    """
    n = len(code) - k + 1
    if n < 1:
        return
    bad = np.cumsum(np.r_[0, code == 255])
    whole = bad[k:] == bad[:n]
    m = min(13, k)
    h = _packed(np.where(code == 255, 0, code), m).astype(np.uint64)
    h = (h + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(30)
    width = 1
    while width < k - m + 1:
        step = min(width, k - m + 1 - width)
        h = np.minimum(h[:-step], h[step:])
        width += step
    home = (h % np.uint64(buckets)).astype(np.int64)
    before = np.cumsum(whole) - whole
    new = whole & np.r_[True, ~whole[:-1] | (home[1:] != home[:-1])]
    first = np.maximum.accumulate(np.where(new, before, 0))
    starts = np.flatnonzero(whole & ((before - first) % (256 - k) == 0))
    if not len(starts):
        return
    sizes = np.diff(np.r_[before[starts], whole.sum()]) + k - 1
    order = np.argsort(home[starts], kind="stable")
    starts, sizes = starts[order], sizes[order]
    ends = np.cumsum(sizes)
    bases = code[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)]
    own = home[starts]
    edges = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        part = bases[ends[i] - sizes[i] : ends[j - 1]]
        quads = np.r_[part, np.zeros(-len(part) % 4, np.uint8)].reshape(-1, 4)
        packed = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
        yield int(own[i]), (j - i).to_bytes(4, "little") + sizes[i:j].astype(np.uint8).tobytes() + packed.tobytes()


def _counted(blocks: list[bytes], k: int, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted k-mers of the stretches and their numbers, added to those known."""
    sizes, bases = [], []
    for block in blocks:
        many = int.from_bytes(block[:4], "little")
        sizes.append(np.frombuffer(block, np.uint8, many, 4))
        bases.append(_QUADS[np.frombuffer(block, np.uint8, -1, 4 + many)].reshape(-1)[: sizes[-1].sum(dtype=np.int64)])
    ends = np.cumsum(np.concatenate(sizes), dtype=np.int64)
    found = _packed(np.concatenate(bases), k)
    inside = np.ones(len(found), bool)
    for j in range(1, k):
        inside[ends[:-1] - j] = False
    own, times = np.unique(found[inside], return_counts=True)
    if not len(code):
        return own, times
    both, at = np.unique(np.r_[code, own], return_inverse=True)
    total = np.zeros(len(both), np.int64)
    total[at[: len(code)]] = n
    total[at[len(code) :]] += times
    return both, total


def _kmer_codes(reads: DataFrame, k: int, least: int = 1) -> DataFrame:
    """``(code, n)`` of ``kmer_count``, k-mers packed into numbers."""
    if not 0 < k <= 31:
        raise ValueError("k must lie between 1 and 31")
    bases = reads.agg(F.sum(F.length("seq")).cast("long").alias("n")).first()["n"] or 0
    buckets = max(64, -(-bases // BUCKET_KMERS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: list[bytes]) -> pa.RecordBatch:
            made = list(_cut(_CODES[np.frombuffer(b"\n".join(held), np.uint8)], k, buckets))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in made], pa.int64()), pa.array([x for _, x in made], pa.binary())], ["bucket", "block"])

        held, many = [], 0
        for batch in batches:
            for x in batch.column("seq"):
                text = (x.as_py() or "").encode("utf-8", "surrogatepass")
                for at in range(0, len(text), PACK_BASES):
                    held.append(text[at : at + PACK_BASES + k - 1])
                    many += len(held[-1])
                    if many >= PACK_BASES:
                        yield rows(held)
                        held, many = [], 0
        if held:
            yield rows(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        last, held, many, known = None, [], 0, none

        def rows() -> Iterator[pa.RecordBatch]:
            code, n = _counted(held, k, *known) if held else known
            code, n = code[n >= least], n[n >= least]
            for at in range(0, len(code), PACK_BASES):
                yield pa.RecordBatch.from_arrays([pa.array(code[at : at + PACK_BASES]), pa.array(n[at : at + PACK_BASES].astype(np.int64))], ["code", "n"])

        for batch in batches:
            for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist()):
                if bucket != last:
                    yield from rows()
                    last, held, many, known = bucket, [], 0, none
                held.append(block)
                many += 4 * len(block)
                if many >= COUNT_KMERS:
                    held, many, known = [], 0, _counted(held, k, *known)
        yield from rows()

    stretches = reads.select("seq").mapInArrow(cut, "bucket long, block binary")
    return stretches.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, "code long, n long")


def _spelled(rows: DataFrame, k: int, *codes: str) -> DataFrame:
    """``rows`` with the k-mers that numbers stand for as text."""
    letters, names = np.frombuffer(b"ACGT", np.uint8), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = {c: batch.column(c) for c in names}
            for c in codes:
                code = arrays[c].to_numpy()
                text = letters[(code[:, None] >> (2 * np.arange(k - 1, -1, -1))) & 3]
                offsets = pa.py_buffer(np.arange(0, k * (len(code) + 1), k, dtype=np.int32).tobytes())
                arrays[c] = pa.StringArray.from_buffers(len(code), offsets, pa.py_buffer(text.tobytes()))
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    return rows.mapInArrow(run, ", ".join(f"{c} {'string' if c in codes else t}" for c, t in rows.dtypes))


def kmer_count(reads: DataFrame, k: int = 29, least: int = 1) -> DataFrame:
    """``(kmer, n)``: canonical k-mers (k of 31 at most) of A, C, G and T in ``seq``, with at least ``least`` occurrences.

    What is shuffled are stretches of bases whose k-mers belong to one bucket, two bits a
    base: a byte or so for each k-mer. A task counts one bucket after the other.
    """
    return _spelled(_kmer_codes(reads, k, least).withColumnRenamed("code", "kmer"), k, "kmer")


def kmer_spectrum(reads: DataFrame, k: int = 29) -> DataFrame:
    """``(n, kmers, first, last)``: how many canonical k-mers occur ``n`` times, and the first and the last of them by text."""
    counted = _kmer_codes(reads, k).groupBy("n").agg(F.count("*").alias("kmers"), F.min("code").alias("first"), F.max("code").alias("last"))
    return _spelled(counted, k, "first", "last")


def _cycles(reads: DataFrame, column: str) -> DataFrame:
    """``(cycle, letter)`` from 1; counted in each task before anything is shuffled."""
    return reads.select(F.posexplode(F.split(column, "")).alias("pos", "letter")).where("letter <> ''").select((F.col("pos") + 1).alias("cycle"), "letter")


def mean_quality_by_cycle(reads: DataFrame) -> DataFrame:
    return _cycles(reads, "qual").groupBy("cycle").agg(F.sum(F.ascii("letter") - 33).alias("total"), F.count("*").alias("n")).select("cycle", (F.col("total") / F.col("n")).alias("mean_quality"), "n")


def base_distribution_by_cycle(reads: DataFrame, bases: str = "ACGTN") -> DataFrame:
    return _cycles(reads, "seq").groupBy("cycle").agg(*[F.count_if(F.col("letter") == b).alias(f"n_{b.lower()}") for b in bases], F.count("*").alias("n"))


def quality_distribution(reads: DataFrame) -> DataFrame:
    return _cycles(reads, "qual").groupBy((F.ascii("letter") - 33).alias("quality")).agg(F.count("*").alias("n"))


def insert_size(reads: DataFrame, widths: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Count, mean, deviation and percentiles of the template length of first mates in mapped pairs."""
    size = F.abs("tlen")
    first = reads.where((F.col("flag").bitwiseAND(0x40) != 0) & (F.col("flag").bitwiseAND(0x4) == 0) & (F.col("tlen") != 0)).select(size.alias("size"))
    return first.agg(F.count("*").alias("n"), F.avg("size").alias("mean"), F.stddev("size").alias("sd"), *[F.percentile("size", F.lit(p)).alias(f"p{round(100 * p)}") for p in widths])


def alignment_stat(reads: DataFrame) -> DataFrame:
    bit = lambda b: F.col("flag").bitwiseAND(b) != 0
    primary = ~bit(0x900)
    return reads.agg(
        F.count_if(primary).alias("reads"),
        F.count_if(primary & ~bit(0x4)).alias("mapped"),
        F.count_if(primary & bit(0x1)).alias("paired"),
        F.count_if(primary & bit(0x2)).alias("proper"),
        F.count_if(primary & bit(0x400)).alias("duplicates"),
        F.avg(F.when(primary, F.length("seq"))).alias("mean_length"),
    )


def gc_bias(reads: DataFrame, windows: DataFrame, step: int) -> DataFrame:
    """``(gc, windows, reads)``: tiles ``(ctg, tile, gc)`` by their GC percentage, and the reads that start in them."""
    starts = reads.groupBy("ctg", F.floor(F.col("start") / step).cast("long").alias("tile")).agg(F.count("*").alias("n"))
    return windows.join(starts, ["ctg", "tile"], "left").groupBy("gc").agg(F.count("*").alias("windows"), F.sum(F.coalesce("n", F.lit(0))).alias("reads"))


def gc_windows(chunks: DataFrame) -> DataFrame:
    """``(ctg, tile, gc)`` of reference chunks ``(ctg, chunk, seq)``: rounded percentage of G and C among A, C, G and T."""
    count = lambda s: F.length("seq") - F.length(F.translate(F.col("seq"), s, ""))
    return chunks.select("ctg", F.col("chunk").alias("tile"), F.round(100 * count("GCgc") / F.when(count("ACGTacgt") > 0, count("ACGTacgt"))).cast("int").alias("gc"))


def coverage_metrics(reads: DataFrame, contigs: DataFrame, step: int = 4096) -> DataFrame:
    """``(depth, bases)``: the genome's bases by depth."""
    return intervals.depth_segments(reads, contigs, step).groupBy("depth").agg(F.sum("bases").alias("bases"))


def wgs_metrics(reads: DataFrame, contigs: DataFrame, include_unpaired: bool = False, step: int = 4096) -> DataFrame:
    """``coverage_metrics`` of mapped primary reads without duplicates; unpaired ones only if asked for."""
    kept = flag_filter(reads, 0xF04, 0)
    return coverage_metrics(kept if include_unpaired else flag_filter(kept, 0x1, 0x1), contigs, step)


def hs_metrics(reads: DataFrame, targets: DataFrame, width: int = intervals.BIN) -> DataFrame:
    """Bases of reads, bases on merged targets, bases of targets and mean depth there."""
    goal = intervals.merge(targets)
    on = intervals.overlap_pairs(reads.select("ctg", "start", "end"), goal, width=width).agg(F.coalesce(F.sum(F.least("end", "end_b") - F.greatest("start", "start_b")), F.lit(0)).alias("on_target"))
    size = goal.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("target_bases"))
    total = reads.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("bases"))
    return total.crossJoin(on).crossJoin(size).withColumn("mean_depth", F.col("on_target") / F.when(F.col("target_bases") > 0, F.col("target_bases")))


def artifact_metrics(mismatches: DataFrame, known: DataFrame) -> DataFrame:
    """``(context, ref, alt, n)`` of mismatches ``(ctg, pos, context, ref, alt)`` that lie at no known site ``(ctg, pos)``."""
    return mismatches.join(known.select("ctg", "pos").distinct(), ["ctg", "pos"], "left_anti").groupBy("context", "ref", "alt").agg(F.count("*").alias("n"))


def flag_filter(reads: DataFrame, mask: int, value: int) -> DataFrame:
    """Reads whose flag bits under ``mask`` equal ``value``."""
    return reads.where(F.col("flag").bitwiseAND(mask) == value)


def mark_duplicates(reads: DataFrame, keys: tuple[str, ...] = ("ctg", "pos5", "strand", "mate"), mode: str = "mark", score: str = "score", read_id: str = "read_id") -> DataFrame:
    """Of reads with equal ``keys`` the one with the best score (then the smallest id) is kept; a null score is the worst.

    mode: ``mark`` adds ``duplicate``, ``remove`` drops duplicates, ``none`` changes
    nothing. Reads with a null key, such as unmapped ones, are no duplicates. The best of
    a group is found by a partial aggregate, so a group of any size needs no window of
    its own. Ids are unique.
    """
    if mode == "none":
        return reads
    rank = F.struct(F.col(score).isNull().alias("none"), (-F.col(score)).alias("score"), F.col(read_id).alias("id"))
    best = reads.groupBy(*keys).agg(F.min_by(read_id, rank).alias("__best"))
    marked = reads.join(best, list(keys), "left").withColumn("duplicate", F.coalesce(F.col(read_id) != F.col("__best"), F.lit(False))).drop("__best")
    return marked if mode == "mark" else marked.where("not duplicate").drop("duplicate")


def consensus(reads: DataFrame, keys: tuple[str, ...] = ("ctg", "pos5", "strand", "mate"), least: int = 2) -> DataFrame:
    """One row ``(keys, reads, seq, qual)`` for each group of at least ``least`` duplicates: at each cycle the base with the largest sum of qualities.

    Of equal sums the base that comes first in the alphabet is taken; the quality is the
    winner's sum less that of the others, between 2 and 60. Reads with a null key,
    sequence or quality are left out.
    """
    whole = reads.dropna(subset=[*keys, "seq", "qual"])
    size = whole.groupBy(*keys).agg(F.count("*").alias("reads"))
    bases = whole.select(*keys, F.posexplode(F.arrays_zip(F.split("seq", "").alias("b"), F.split("qual", "").alias("q"))).alias("cycle", "x"))
    sums = bases.where("x.b <> '' and x.q <> ''").groupBy(*keys, "cycle", F.col("x.b").alias("base")).agg(F.sum(F.ascii("x.q") - 33).alias("q"))
    called = sums.groupBy(*keys, "cycle").agg(F.min_by("base", F.struct((-F.col("q")).alias("q"), "base")).alias("base"), (2 * F.max("q") - F.sum("q")).alias("q"))
    letter = F.expr("char(33 + greatest(2, least(60, q)))")
    rows = called.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("cycle", "base", letter.alias("q")))).alias("c"))
    text = lambda f: F.array_join(F.transform("c", lambda x: x[f]), "").alias(f if f != "base" else "seq")
    return size.where(F.col("reads") >= least).join(rows, list(keys)).select(*keys, "reads", text("base"), text("q").alias("qual"))


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    return marked.agg(F.count("*").alias("reads"), F.count_if("duplicate").alias("duplicates"))


def collate(reads: DataFrame, name: str = "read_id", number: str = "read_no") -> DataFrame:
    """``(name, first, second)``: primary reads by name, the two of a pair as structs of all their columns; null where one is missing.

    Secondary and supplementary records (flag bits 0x900) are left out; of several with
    one name and number the one with the smallest flag, then the smallest content, is taken.
    """
    primary = reads.where(F.col("flag").bitwiseAND(0x900) == 0)
    row = F.struct(*reads.columns)
    one = lambda k: F.min(F.when(F.col(number) == k, F.struct(F.col("flag").alias("f"), row.alias("r"))))["r"]
    return primary.groupBy(name).agg(one(1).alias("first"), one(2).alias("second"))

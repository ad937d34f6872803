"""Combining a gVCF with calls, transferring population annotations, and choosing regions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import alleles as A
from ..operators import filters, intervals, joins
from ..operators.normalise import left_align
from ..sources.text import CHUNK, FORMAT_NUMBERS, INFO_NUMBERS, ref_slice

NON_REF = "<NON_REF>"


def cutting_calls(blocks: DataFrame, calls: DataFrame, width: int = intervals.BIN) -> DataFrame:
    """``(vid, start, end)`` of the calls that cut a block (unique ``vid``): those that begin in it and not within a call that has cut it before.

    Calls are taken by pos and end. They stream through a task sorted by block, which
    holds the end of the last one only.
    """
    begins = intervals.points(calls.select("ctg", "pos", F.col("end").alias("stop")))
    spans = blocks.select("ctg", F.col("pos").alias("start"), "end", "vid")
    inside = intervals.overlap_pairs(begins, spans, width).select(F.col("vid_b").alias("vid"), F.col("pos").alias("start"), F.col("stop").alias("end"))

    def greedy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, reached = None, 0
        for x in batches:
            keep = []
            for vid, start, end in zip(x["vid"], x["start"], x["end"]):
                free = vid != block or start >= reached
                if free:
                    block, reached = vid, end
                keep.append(free)
            yield x[keep]

    placed = inside.repartition("vid").sortWithinPartitions("vid", "start", "end")
    return placed.mapInPandas(greedy, placed.schema)


def split_blocks(blocks: DataFrame, calls: DataFrame, chunks: DataFrame | None = None, width: int = intervals.BIN) -> DataFrame:
    """Reference blocks (one ALT; unique ``vid``) without the bases of the calls that begin in them; a piece that begins after a call gets its own first base.

    A call that reaches over the end of its block leaves the next block whole, and one
    that begins within an earlier call cuts nothing. ``chunks``: the reference, see
    ``sources.text``; without it such a base is ``N``.
    """
    cuts = cutting_calls(blocks, calls, width).select("vid", F.array(F.col("start"), F.col("end")).alias("cut"))
    own = F.struct(*blocks.columns)
    marks = blocks.select(F.col("vid").alias("__vid"), own.alias("__own"), F.array("pos", "pos").alias("cut"), F.lit(0).alias("__kind"))
    marks = marks.unionByName(cuts.select(F.col("vid").alias("__vid"), F.lit(None).cast(marks.schema["__own"].dataType).alias("__own"), "cut", F.lit(1).alias("__kind")))
    w = Window.partitionBy("__vid").orderBy("__kind", F.get("cut", F.lit(0)))
    whole = F.first("__own", ignorenulls=True).over(Window.partitionBy("__vid"))
    nxt = F.lead(F.get("cut", F.lit(0))).over(w)
    pieces = marks.select(whole.alias("__own"), F.get("cut", F.lit(1)).alias("start"), nxt.alias("__next")).select("__own.*", "start", "__next")
    pieces = pieces.select(*blocks.columns, "start", F.coalesce("__next", "end").alias("stop")).where("start < stop")
    base = F.when(F.col("start") == F.col("pos"), F.col("ref")).otherwise("N")
    if chunks is not None:
        keyed = pieces.withColumn("__key", F.concat_ws(":", "vid", "start"))
        bases = ref_slice(keyed.select("__key", "ctg", "start", (F.col("start") + 1).alias("end")), chunks, "__key").select("__key", "bases")
        pieces = keyed.join(bases, "__key").drop("__key")
        base = F.when(F.col("start") == F.col("pos"), F.col("ref")).otherwise(F.col("bases"))
    return pieces.withColumn("ref", base).withColumns({"pos": F.col("start"), "end": F.col("stop")}).select(*blocks.columns)


def add_nonref(calls: DataFrame, compat: bool = False) -> DataFrame:
    """Calls with ``<NON_REF>`` as one more ALT: likelihood 100 where it takes part, its depth what is left, its counts and frequencies 0."""
    n, ploidy = F.size("alt") + 1, A.ploidy_of_gt("GT")
    new = {"alt": F.concat("alt", F.array(F.lit(NON_REF))), "PL": F.when(F.col("PL").isNotNull(), A.add_nonref_pl("PL", n, ploidy, compat)), "AD": F.when(F.col("AD").isNotNull(), A.add_nonref_ad("AD", "DP"))}
    for field, zero in (("AC", 0), ("MLEAC", 0), ("AF", 0.0), ("MLEAF", 0.0), ("RPA", 0)):
        if field in calls.columns:
            new[field] = F.when(F.col(field).isNotNull(), F.concat(field, F.array(F.lit(zero))))
    return calls.withColumns(new)


def gvcf_combine(gvcf: DataFrame, calls: DataFrame, chunks: DataFrame | None = None, compat: bool = False, width: int = intervals.BIN) -> DataFrame:
    """A gVCF with its calls replaced: ``ctg, pos, end, ref, alt, GT, GQ, DP, PL, AD`` and ``vid``, unique in ``gvcf``.

    Blocks lose the bases of calls that begin in them. A row with several ALTs stays as a REF call where no
    call begins, goes where one of its own end or a later one does, and leaves what
    reaches beyond the call as a block of GQ 15, up to the next row of the gVCF, which
    later calls may cut. Calls get ``<NON_REF>``. The ALT of a block alone is ``<NON_REF>``.
    """
    columns = ["ctg", "pos", "end", "ref", "alt", "GT", "GQ", "DP", "PL", "AD"]
    own = ["vid", *columns]
    at = calls.groupBy("ctg", "pos").agg(F.max("end").alias("__end"))
    several = gvcf.where(F.size("alt") > 1).join(at, ["ctg", "pos"], "left")
    plain = several.where("__end is null").withColumn("GT", A.homref_gt(A.ploidy_of_gt("GT"))).select(*columns)
    rest = several.where("end > __end").join(_next_start(gvcf), ["ctg", "pos"], "left")
    size = A.ploidy_of_gt("GT")
    rest = rest.select(F.concat_ws(":", "vid", F.lit("rest")).alias("vid"), "ctg", F.col("__end").alias("pos"), F.coalesce("__next", "end").alias("end"), F.substring(F.col("ref"), (F.col("__end") - F.col("pos") + 1).cast("int"), F.lit(1)).alias("ref"), F.array(F.lit(NON_REF)).alias("alt"), A.homref_gt(size).alias("GT"), F.lit(15).alias("GQ"), "DP", F.transform(A.upto(size + 1), lambda i: i * 20).alias("PL"), F.lit(None).cast("array<int>").alias("AD"))
    whole = gvcf.where(F.size("alt") == 1).withColumn("vid", F.col("vid").cast("string")).select(*own).unionByName(rest.where("pos < end").select(*own))
    blocks = split_blocks(whole, calls, chunks, width).select(*columns)
    return blocks.unionByName(plain).unionByName(add_nonref(calls, compat).select(*columns))


def _next_start(rows: DataFrame) -> DataFrame:
    """``(ctg, pos, __next)``: for each position the next one that has a row; carried over bins from the end."""
    places = rows.select("ctg", "pos").distinct().select("ctg", (-F.col("pos")).alias("start"), F.lit(0).cast("long").alias("end"))
    seen = intervals.running_max(places, F.col("start"), "__x", before=True)
    return seen.select("ctg", (-F.col("start")).alias("pos"), (-F.col("__x")).alias("__next"))


def gvcf_to_calls(g: DataFrame) -> DataFrame:
    """Calls of a one-sample gVCF: blocks and REF calls go, and so does ``<NON_REF>``."""
    kept = filters.exclude_homref(g.where(F.size("alt") > 1))
    real = F.filter(F.transform(A.upto(F.size("alt")), lambda i: i + 1), lambda i: F.get("alt", i - 1) != NON_REF)
    kept = kept.withColumn("__keep", F.concat(F.array(F.lit(0)), real))
    new = {"PL": A.subset_g("PL", F.col("__keep"), F.size("alt")), "AD": A.subset_r("AD", F.col("__keep"))}
    return kept.withColumns({k: v for k, v in new.items() if k in g.columns}).withColumn("alt", F.filter("alt", lambda a: a != NON_REF)).drop("__keep")


def trim_added_alts(v: DataFrame, number_a: tuple[str, ...] = ("AF",), number_r: tuple[str, ...] = ("AD",), number_g: tuple[str, ...] = ("PL",), info: dict[str, str] | None = None, samples: dict[str, str] | None = None) -> DataFrame:
    """Cuts the ALTs that only the population table has; ``AF`` (texts) is the caller's own. GT stays as it is.

    Typed columns are named by their Number; ``info`` and ``samples``, the header's Number
    by field (``sources.text.field_numbers``), do the same for the maps of texts in the
    columns ``info`` and ``samples``, so that the record stays valid. Genotype fields occur
    in samples only. Rows that lose an ALT lose as many last bases as all remaining alleles
    can spare; those are taken to be shared, as in padded alleles. Symbolic ALTs do not
    count and stay whole.
    """
    # rows that lose an ALT and rows that lose none are worked out in one pass over the input
    keep = v.withColumn("__keep", A.added_alts("alt", "AF"))
    rows = keep.withColumns({"__alts": F.size("alt"), "__all": F.size("__keep") == F.size("alt") + 1}).where("__all is not null")
    n, whole = F.col("__alts"), F.col("__all")  # columns: inside lambda functions the name alt would be taken for the new one
    new = {c: A.subset_a(c, F.col("__keep")) for c in number_a} | {c: A.subset_r(c, F.col("__keep")) for c in number_r} | {c: A.subset_g(c, F.col("__keep"), n) for c in number_g}
    new = {k: x for k, x in new.items() if k in v.columns}
    if info and "info" in v.columns:
        new["info"] = A.subset_fields("info", {k: x for k, x in info.items() if x != "G"}, F.col("__keep"), n)
    if samples and "samples" in v.columns:
        new["samples"] = F.transform("samples", lambda s: A.subset_fields(s, samples, F.col("__keep"), n))
    new["alt"] = A.subset_a("alt", F.col("__keep"))
    some = rows.withColumns({c: F.when(whole, F.col(c)).otherwise(x) for c, x in new.items()})
    plain = F.filter("alt", lambda a: ~a.startswith("<"))
    spare = F.when(F.size(plain) > 0, F.aggregate(plain, F.length("ref"), lambda n, a: F.least(n, F.length(a))) - 1).otherwise(0)
    some = some.withColumn("__n", F.greatest(spare, F.lit(0)))
    cut = lambda a: F.substring(a, F.lit(1), F.length(a) - F.col("__n"))
    shorter = {"ref": cut(F.col("ref")), "alt": F.transform("alt", lambda a: F.when(a.startswith("<"), a).otherwise(cut(a)))}
    return some.withColumns({c: F.when(whole, F.col(c)).otherwise(x) for c, x in shorter.items()}).drop("__n", "__alts", "__all", "__keep")


def transfer(raw: DataFrame, pop: DataFrame, key: str, rules: dict[str, str], info: dict[str, str] | None = None, samples: dict[str, str] | None = None) -> DataFrame:
    """Population values on calls: ALTs that the caller does not know are cut, and rows without a FORMAT or a frequency of the caller's own go.

    ``info`` and ``samples``: the Number of the header's fields, by which the texts of both
    are cut too (default: the reserved fields). See ``joins.transfer_annotations``,
    ``trim_added_alts`` and ``filters.drop_no_call``.
    """
    called = filters.drop_no_call(filters.drop_site_only(raw)).withColumn("AF", F.split(F.col("info")["AF"], ","))
    values = tuple(f"pop_{f}" for f in rules)
    marked = joins.transfer_annotations(called, pop, key, rules)
    return trim_added_alts(marked, ("AF", *values), info=INFO_NUMBERS if info is None else info, samples=FORMAT_NUMBERS if samples is None else samples).drop("AF")


def select_regions(v: DataFrame, contigs: DataFrame, n: int = 1000) -> DataFrame:
    """Regions around calls that the hybrid rules pass, widened by ``n``."""
    passed = filters.hybrid_filter(v).where("filter = 'PASS'")
    return intervals.slop(filters.bed_columns(passed), n, contigs)


def difference_regions(v: DataFrame, low_mapq: DataFrame, contigs: DataFrame, n: int = 1000) -> DataFrame:
    """``select_regions`` and the regions of low mapping quality, widened too, as one union."""
    return intervals.cat_sort_merge([select_regions(v, contigs, n), intervals.slop(low_mapq.select("ctg", "start", "end"), n, contigs)])


def annotate_hap_count(v: DataFrame, bed: DataFrame, width: int = intervals.BIN) -> DataFrame:
    return intervals.annotate_interval(v, bed, "LHC", width)


def finalise(v: DataFrame, gvcf: bool = False, chunks: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Calls without unused ALTs and, unless for a gVCF, without REF calls; with ``chunks``, the reference, indels are moved to the left (``vid``, pos and end are needed then)."""
    kept = filters.trim_unused_alts(filters.exclude_homref(v, gvcf))
    return kept if chunks is None else left_align(kept, chunks, chunk)


def combine_cnv(cnv: DataFrame, converted: DataFrame, neutral: int = 2, fraction: float = 0.5, width: int = intervals.BIN) -> DataFrame:
    """``(cid, ctg, pos, end, CN, SOURCE, filter, DEDUP, source_order)`` of CNV calls and calls converted from indels.

    ``cnv``: ``cid`` (rows that share one share the range found), ctg, pos, end, CN, filter; those that do not pass or are
    neutral go. ``converted``: also CNDIFF, REFSTART, REFSTOP; all stay, with their copy
    number. A loss that a converted loss covers by at least ``fraction`` is SVdup, and
    DEDUP names the first such range; gains never are. Order by pos, ``source_order``, cid.
    """
    called = filters.drop_nonpass_and_neutral(cnv, neutral)
    known = converted.where("CNDIFF < 0 and REFSTART < REFSTOP").select("ctg", F.col("REFSTART").alias("start"), F.col("REFSTOP").alias("end"))
    losses = called.where(F.col("CN") < neutral).select("cid", "ctg", F.col("pos").alias("start"), "end")
    hit = intervals.fraction_overlap(losses, known, fraction, width=width).where("hit_start is not null")
    # one row for each cid, so that rows which share theirs are not multiplied
    first = hit.groupBy("cid").agg(F.min(F.struct("hit_start", "hit_end")).alias("__hit"))
    dedup = F.when(F.col("__hit").isNotNull(), F.concat("ctg", F.lit(":"), "__hit.hit_start", F.lit("-"), "__hit.hit_end"))
    marked = called.join(first, "cid", "left").withColumns({"DEDUP": dedup, "filter": F.when(F.col("__hit").isNotNull(), F.array(F.lit("SVdup"))).otherwise(F.col("filter"))})
    columns = ["cid", "ctg", "pos", "end", "CN", "SOURCE", "filter", "DEDUP", "source_order"]
    own = converted.withColumns({"CN": A.copy_number(F.coalesce("CNDIFF", F.lit(0)), neutral), "SOURCE": F.lit("SV_CNV"), "DEDUP": F.lit(None).cast("string"), "source_order": F.lit(0)})
    return own.select(*columns).unionByName(marked.withColumns({"SOURCE": F.lit("CNV"), "source_order": F.lit(1)}).select(*columns))

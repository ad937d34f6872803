"""Row filters on variants, calls and reads. All are stateless, so they hold for streams too.

Variant columns: ``ctg, pos, end, ref, alt array, qual, filter array, info map, format
array, GT`` and typed fields named as in the file, such as ``PL`` or ``AD``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alleles as A
from .aggregates import flag_filter

__all__ = ["flag_filter", "filter_pass", "exclude_homref", "min_indel_size", "bed_columns", "drop_site_only", "drop_no_call", "qualifying_sv", "select_contigs", "drop_nonpass_and_neutral", "hybrid_filter", "confident_reference", "relabel_sample", "strip_contig_prefix", "select_phase", "trim_unused_alts"]


def filter_pass(v: DataFrame) -> DataFrame:
    """FILTER is PASS or empty."""
    return v.where((F.size("filter") == 0) | (F.col("filter") == F.array(F.lit("PASS"))))


def exclude_homref(v: DataFrame, gvcf: bool = False) -> DataFrame:
    return v if gvcf else v.where(F.col("GT").isNull() | ~F.col("GT").isin("0/0", "0|0"))


def min_indel_size(v: DataFrame, n: int = 34) -> DataFrame:
    return v.where(F.exists("alt", lambda a: F.abs(F.length(a) - F.length("ref")) > n))


def bed_columns(v: DataFrame) -> DataFrame:
    return v.select("ctg", F.col("pos").alias("start"), "end")


def drop_site_only(v: DataFrame) -> DataFrame:
    return v.where(F.size("format") > 0)


def drop_no_call(v: DataFrame) -> DataFrame:
    """Drops rows without ``<NON_REF>`` and without a frequency of the caller's own."""
    return v.where(F.array_contains("alt", "<NON_REF>") | F.col("info")["AF"].isNotNull())


def qualifying_sv(v: DataFrame, least: int = 400) -> DataFrame:
    longest = F.array_max(F.transform(F.concat(F.array("ref"), F.col("alt")), lambda a: F.length(a)))
    return v.where(((F.size("filter") == 0) | F.array_contains("filter", "PASS")) & (longest >= least))


def select_contigs(v: DataFrame, contigs: list[str], known: DataFrame) -> DataFrame:
    """Rows of the named contigs; naming none of ``known (ctg)`` is an error."""
    if known.where(F.col("ctg").isin(contigs)).limit(1).count() == 0:
        raise ValueError("none of the contigs is in the file")
    return v.where(F.col("ctg").isin(contigs))


def drop_nonpass_and_neutral(cnv: DataFrame, neutral: int = 2) -> DataFrame:
    return filter_pass(cnv).where(F.col("CN").isNotNull() & (F.col("CN") != neutral))


def hybrid_filter(v: DataFrame, least_short: int = 30, least_depth: int = 2, least_long: int = 30) -> DataFrame:
    """``v`` with ``filter``: the first rule that holds, else PASS; null if a likelihood array has no zero.

    Missing arrays count as three zeros. Confidence is the second smallest likelihood;
    for a long-read call other than REF outside of repeats it is that of REF.
    """
    zeros = F.array(*[F.lit(0)] * 3)
    lpl, spl = F.coalesce("LPL", zeros), F.coalesce("SPL", zeros)
    best_long, best_short = F.array_position(lpl, F.lit(0)), F.array_position(spl, F.lit(0))
    repeat = F.coalesce(F.col("STR"), F.lit(False))
    conf_long = F.when(~repeat & (best_long > 1), F.get(lpl, F.lit(0))).otherwise(A.second_smallest(lpl))
    sure_short = A.second_smallest(spl) >= least_short
    depth = F.aggregate(F.coalesce("LAD", zeros), F.lit(0).cast("long"), lambda s, x: s + x)
    name = (
        F.when((best_long == 0) | (best_short == 0), None)
        .when(depth < least_depth, "longread_lowdepth")
        .when(conf_long < least_long, "longread_lowconf")
        .when(sure_short & (best_long == best_short), "same_gt")
        .when(sure_short & (best_long == 1) & repeat, "longread_str")
        .otherwise("PASS")
    )
    return v.withColumn("filter", name)


def confident_reference(pl: Column | str, gq: Column | str, least: int = 20) -> Column:
    """Whether the best likelihood is that of REF, 0, with a GQ of at least ``least``."""
    pl, gq = (F.col(c) if isinstance(c, str) else c for c in (pl, gq))
    return F.coalesce((F.get(pl, F.lit(0)) == 0) & (gq >= least), F.lit(False))


def relabel_sample(reads: DataFrame, groups: DataFrame, sample: str, long_reads: bool = False, suffix: str = "") -> DataFrame:
    """``reads`` and the tags of their read group ``(rg, tags map)``, with SM set and, for long reads, LR=1.

    ``suffix`` is added to the group's id, in ``rg`` and in its tag, so that groups of
    several aligners stay apart.
    """
    new = {"SM": F.lit(sample)} | ({"LR": F.lit("1")} if long_reads else {}) | ({"ID": F.concat("rg", F.lit(suffix))} if suffix else {})
    kept = groups.select("rg", F.map_concat(F.map_filter("tags", lambda k, _: ~k.isin(*new)), F.map_from_arrays(F.array(*map(F.lit, new)), F.array(*new.values()))).alias("tags"))
    return reads.join(kept, "rg", "left").withColumn("rg", F.concat("rg", F.lit(suffix)))


def strip_contig_prefix(v: DataFrame, prefix: str) -> DataFrame:
    """``ctg`` without the prefix; of sequence lines ``tags map`` too: SN without it, and no M5, which belongs to the named sequence."""
    cut = lambda c: F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)
    named = v.withColumn("ctg", cut(F.col("ctg")))
    if "tags" not in v.columns:
        return named
    renamed = F.transform_values(F.map_filter("tags", lambda k, _: k != "M5"), lambda k, x: F.when(k == "SN", cut(x)).otherwise(x))
    return named.withColumn("tags", F.when(v["ctg"].startswith(prefix), renamed).otherwise(F.col("tags")))


def select_phase(reads: DataFrame, haplotype: int | None = None) -> DataFrame:
    """Reads of a haplotype, or all that have one."""
    return reads.where(F.col("HP").isNotNull() if haplotype is None else F.col("HP") == haplotype)


def trim_unused_alts(v: DataFrame) -> DataFrame:
    """Keeps the ALTs that the genotype names and renumbers it; rows that name none stay as they are."""
    used = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), A.gt_alleles("GT"))))
    # a generator stands between the alleles kept and what is made of them, so each is worked out once
    rows = v.select("*", F.explode(F.array(used)).alias("__used"))
    rows = rows.select("*", F.explode(F.array(A.subset_alleles("ref", "alt", F.col("__used")))).alias("__t"))
    some = F.size("__used") > 1
    new = {"ref": F.when(some, F.col("__t.ref")).otherwise(F.col("ref")), "alt": F.when(some, F.col("__t.alts")).otherwise(F.col("alt")), "GT": F.when(some, A.remap_gt("GT", F.col("__used"))).otherwise(F.col("GT"))}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in v.columns])

"""Operators on the order of values in a row's series, and of candidates of a variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.text import CHUNK, ref_slice
from . import intervals


def find_peaks(series: DataFrame, distance: int = 1, height: float = 0.0) -> DataFrame:
    """``(id, peaks array<int>)`` of ``(id, series array<double>)``, ids being unique.

    A peak is a run of equal values of at least ``height`` between lower neighbours, at
    its middle (rounded down); the first and last value are none. Of peaks closer than
    ``distance`` the higher stays, of equal ones the earlier. A null series has null.
    """
    w = Window.partitionBy("id").orderBy("i")
    points = series.select("id", F.posexplode("series").alias("i", "y"))
    points = points.withColumn("run", F.sum(F.when(F.lag("y").over(w) == F.col("y"), 0).otherwise(1)).over(w))
    runs = points.groupBy("id", "run").agg(F.min("i").alias("first"), F.max("i").alias("last"), F.first("y").alias("y"))
    by = Window.partitionBy("id").orderBy("run")
    runs = runs.withColumns({"before": F.lag("y").over(by), "after": F.lead("y").over(by)})
    tops = runs.where((F.col("y") >= height) & (F.col("before") < F.col("y")) & (F.col("after") < F.col("y")))
    ranked = tops.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("y")).alias("h"), F.floor((F.col("first") + F.col("last")) / 2).cast("int").alias("i")))).alias("__ranked"))
    kept = F.aggregate("__ranked", F.array().cast("array<int>"), lambda s, x: F.when(F.exists(s, lambda q: F.abs(q - x["i"]) < distance), s).otherwise(F.concat(s, F.array(x["i"]))))
    found = ranked.select("id", F.array_sort(kept).alias("peaks"))
    return series.select("id", "series").join(found, "id", "left").select("id", F.when(F.col("series").isNotNull(), F.coalesce("peaks", F.array().cast("array<int>"))).alias("peaks"))


def best_period(candidates: DataFrame, key: str = "vid", slack: float = 0.01) -> DataFrame:
    """Of each variant's candidates ``(ratio, matched, rank)``: among those within ``slack`` of the best ratio the longest match, then the first."""
    top = candidates.groupBy(key).agg(F.max("ratio").alias("__top"))
    near = candidates.join(top, key).where((F.col("ratio") == F.col("__top")) | (F.col("__top") - F.col("ratio") < slack))
    row = F.struct(*[c for c in candidates.columns if c != key])
    return near.groupBy(key).agg(F.max_by(row, F.struct("matched", (-F.col("rank")).alias("r"))).alias("__row")).select(key, "__row.*")


def _whole(rows: DataFrame) -> DataFrame:
    """``rows`` with a generator by which all columns are read, and no condition is handed on, whatever follows: what is told apart above then shares the shuffle below."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def merge_opposite_phase(v: DataFrame, chunks: DataFrame, gap: int = 10, chunk: int = CHUNK, width: int = intervals.SPAN) -> DataFrame:
    """Adjacent het insertions 1|0 and 0|1 with one ALT each, at most ``gap`` bases apart, become one 1|1 row with both ALTs.

    REF and the first ALT grow by the reference bases from the end of the first row to
    the place of the second; the second ALT is that REF without its last base and the
    second row's ALT. REF of the first row is no longer than either ALT. Rows follow one
    another by ``pos, vid``; of a run of rows that could merge the first and second make a
    pair, the third and fourth the next. ``chunks``: the reference, see ``sources.text``.
    Rows are dealt to tasks once, by bins of ``width`` bases, and only those that have
    another row near them go on from there.
    """
    here = Window.partitionBy("ctg", "__bin").orderBy("pos")
    rows = v.withColumn("__bin", intervals.bin_of("pos", width))
    first_bin, next_bin = F.col("__bin") * width, (F.col("__bin") + 1) * width
    begins = F.coalesce(F.col("pos") - F.lag("pos").over(here) > gap, F.lit(True))
    ends = F.coalesce(F.lead("pos").over(here) - F.col("pos") > gap, F.lit(True))
    rows = rows.withColumns({"__begins": begins, "__ends": ends})
    rows = rows.withColumn("__cluster", F.max(F.when(F.col("__begins"), F.col("pos"))).over(here))
    edge = (F.min("pos").over(Window.partitionBy("ctg", "__bin", "__cluster")) - first_bin < gap) | (next_bin - F.max("pos").over(Window.partitionBy("ctg", "__bin", "__cluster")) <= gap)
    rows = rows.withColumn("__edge", F.coalesce(edge, F.lit(False)))
    # a row that no other is near to stays as it is, where it is; clusters at an edge of their bin, few in each, are looked at along the contig
    lone = F.col("__begins") & F.col("__ends") & ~F.col("__edge")
    alone = _whole(rows.where(lone).select(*v.columns))
    rows = rows.where(~lone).withColumns({c: F.when(~F.col("__edge"), F.col(c)) for c in ("__bin", "__cluster")})
    w = Window.partitionBy("ctg", "__bin", "__cluster").orderBy("pos", "vid")
    one = (F.size("alt") == 1) & F.col("GT").isin("1|0", "0|1")
    first = F.get("alt", F.lit(0))
    rows = rows.withColumns({"__ok": one, "__alt": first})
    before = lambda c: F.lag(c).over(w)
    joins = F.col("__ok") & before("__ok") & (before("GT") != F.col("GT")) & (F.col("pos") - before("pos") <= gap) & (F.length(before("ref")) <= F.length("__alt")) & (F.length(before("ref")) <= F.length(before("__alt")))
    rows = rows.withColumns({"__join": F.coalesce(joins, F.lit(False)), "__from": before("end")})
    rows = rows.withColumn("__run", F.sum(F.when(F.col("__join"), 0).otherwise(1)).over(w))
    place = F.row_number().over(Window.partitionBy("ctg", "__bin", "__cluster", "__run").orderBy("pos", "vid")) - 1
    rows = rows.withColumns({"__pair": F.floor(place / 2), "__second": place % 2 == 1})
    own = [c for c in v.columns if c != "ctg"]
    half = lambda second, c: F.max(F.when(F.col("__second") == second, F.col(c)))
    pairs = rows.groupBy("ctg", "__bin", "__cluster", "__run", "__pair").agg(F.max_by(F.struct(*own), ~F.col("__second")).alias("__v"), half(True, "__alt").alias("__alt2"), half(True, "__from").alias("start"), (half(True, "pos") + 1).alias("__end"))
    plain = pairs.where("__alt2 is null").select("ctg", "__v.*").select(*v.columns)
    merged = _whole(pairs.where("__alt2 is not null").select("ctg", F.col("__v.vid").alias("vid"), "__v", "__alt2", "start", F.col("__end").alias("end")))
    merged = ref_slice(merged, chunks, "vid", chunk, "__gap").select("ctg", "__v.*", "__alt2", "__gap")
    ref = F.concat("ref", "__gap")
    new = {"ref": ref, "alt": F.array(F.concat(first, F.col("__gap")), F.concat(F.substring(ref, F.lit(1), F.length(ref) - 1), F.col("__alt2"))), "GT": F.lit("1|1")}
    return alone.unionByName(plain).unionByName(merged.select(*[new.get(c, F.col(c)).alias(c) for c in v.columns]))

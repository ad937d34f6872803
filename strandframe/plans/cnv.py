"""Copy-number calls from long insertions and deletions: the lag profile of a sequence, its period, and the fold of overlapping calls."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import alleles as A
from ..operators import filters, intervals, joins, sequence
from ..operators.normalise import _stored
from ..sources.text import CHUNK, ref_slice

#: Shortest sequence that can hold a repeat, bases from lag to lag, and the height of a peak of the profile.
LEAST, STEP, HEIGHT = 400, 100, 0.95
#: Under this similarity nothing is taken for a match beside a call.
UNLIKE = 0.8
#: Share of a range that must be common, and how far a ratio of periods may be from a whole number.
COMMON, WHOLE = 0.9, 0.1
#: Longest insertion or deletion that is searched, and units by which an array is extended at most.
LONGEST, MOST_STEPS = 200_000, 200


def lag_profile(seqs: DataFrame, least: int = LEAST, step: int = STEP, threshold: float = 0.0) -> DataFrame:
    """``(id, step, series)`` of ``(id, seq)``: similarity of the first n bases and the n after them, for n from two steps up to half the length and five steps more.

    A step is ``step`` bases, twice as many in a sequence of over 20 of them; shorter
    sequences than ``least`` have no row. Every lag is a row of its own, so long sequences
    spread over tasks. Similarities under ``threshold`` may be 0.
    """
    length = F.length("seq")
    step = F.when(length > 20 * step, 2 * step).otherwise(step)
    rows = seqs.where(length >= least).select("id", "seq", step.alias("step"), F.least(F.floor(length / 2) + step * 5, length - step).cast("int").alias("stop"))
    rows = rows.where(F.col("stop") > 2 * F.col("step")).select("id", "seq", "step", F.explode(F.sequence(2 * F.col("step"), F.col("stop") - 1, F.col("step"))).alias("n"))
    scored = rows.select("id", "step", "n", F.substring(F.col("seq"), F.lit(1), F.col("n")).alias("a"), F.substring(F.col("seq"), F.col("n") + 1, F.col("n")).alias("b"))
    scored = scored.repartition("id", "n").select("id", "step", "n", joins.lcs_ratio("a", "b", threshold).alias("ratio"))
    return scored.groupBy("id", "step").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "ratio"))), lambda x: x["ratio"]).alias("series"))


def first_period(seqs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(id, period)``: the period by least squares over the peaks of the profile, before it is refined; the length where nothing repeats."""
    return _first_estimate(seqs, threshold).select("id", F.coalesce("period", "length").alias("period"))


def _first_estimate(seqs: DataFrame, threshold: float, least: int = LEAST, step: int = STEP) -> DataFrame:
    """``(id, length, period)``, null where nothing repeats; without a peak the middle is tried."""
    profile = _stored(lag_profile(seqs, least, step, min(threshold, HEIGHT)))
    peaks = _stored(sequence.find_peaks(profile.select("id", "series"), distance=2, height=HEIGHT))
    rows = seqs.where(F.length("seq") >= least).select("id", F.length("seq").alias("length")).join(profile, "id", "left").join(peaks, "id", "left")
    mid = F.floor(F.length("seq") / 2).cast("int")
    halves = F.explode(F.array(joins.lcs_ratio(F.substring(F.col("seq"), F.lit(1), mid), F.substring(F.col("seq"), mid + 1, mid), threshold)))
    flat = peaks.where(F.size("peaks") == 0).select("id").join(seqs.select("id", "seq"), "id").select("id", halves.alias("half"))
    rows = rows.join(flat, "id", "left")
    middle = F.when(F.col("half") > threshold, F.array(F.floor(F.col("length") / 2) / F.col("step"))).otherwise(F.array().cast("array<double>"))
    at = F.when(F.size("peaks") > 0, F.transform("peaks", lambda p: (p + 2).cast("double"))).otherwise(middle)
    rows = rows.select("id", "length", "step", F.array_max("series").alias("top"), at.alias("at"))
    gaps = F.zip_with(F.slice("at", 2, F.greatest(F.size("at") - 1, F.lit(0))), F.slice("at", 1, F.greatest(F.size("at") - 1, F.lit(0))), lambda x, y: x - y)
    rows = rows.withColumn("unit", F.when(F.size("at") > 0, F.array_min(F.concat(gaps, F.slice("at", 1, 1)))))
    order = F.transform("at", lambda p: F.bround(p / F.col("unit")))
    fit = F.aggregate(F.zip_with("at", order, lambda p, k: k * p), F.lit(0.0), lambda s, x: s + x) / F.aggregate(order, F.lit(0.0), lambda s, k: s + k * k)
    period = F.floor(F.when(F.size("at") > 1, fit).otherwise(F.get("at", F.lit(0))) * F.col("step")).cast("int")
    repeats = (F.col("top") >= threshold) & (F.size("at") > 0) & (F.bround(F.col("length") / period) >= 2)
    return rows.select("id", F.col("length").cast("int").alias("length"), F.when(F.coalesce(repeats, F.lit(False)), period).alias("period"))


def _best_ratio(rows: DataFrame, seqs: DataFrame) -> DataFrame:
    """``rows (id, p, n)`` and ``ratio``: the best similarity of a stretch of p bases and the next one, among the first n stretches of the sequence."""
    pairs = rows.where("n > 1").select("id", "p", F.explode(A.upto(F.col("n") - 1)).alias("i")).join(seqs, "id")
    one = F.substring(F.col("seq"), F.col("i") * F.col("p") + 1, F.col("p"))
    two = F.substring(F.col("seq"), (F.col("i") + 1) * F.col("p") + 1, F.col("p"))
    scored = pairs.repartition("id", "p", "i").select("id", "p", F.explode(F.array(joins.lcs_ratio(one, two))).alias("ratio"))
    return scored.groupBy("id", "p").agg(F.max("ratio").alias("ratio"))


def find_periods(seqs: DataFrame, threshold: float = 0.9, least: int = LEAST, step: int = STEP) -> DataFrame:
    """J15: ``(id, period)`` of all likely periods of ``(id, seq)``, ids being unique; the length where nothing repeats, no row for less than ``least`` bases.

    The first estimate is refined in rounds with a finer step each, until the step of
    every sequence is one base; then its multiples are tried. Periods shorter than ``least``
    go, and so do those that lie more than 0.03 below the best, or below the threshold.
    """
    # what several steps read is worked out once
    seqs = _stored(seqs.select("id", "seq").where(F.length("seq") >= least).repartition("id"))
    found = _stored(_first_estimate(seqs, threshold, least, step))
    whole = found.where("period is null").select("id", F.col("length").alias("period"))
    state = found.where("period is not null").withColumn("n", F.bround(F.col("length") / F.col("period")).cast("int"))
    low, high = (F.floor(F.col("length") / (F.col("n") + d)).cast("int") for d in (0.5, -0.5))
    finer = lambda c: F.greatest(F.lit(1), F.floor(c / 10).cast("int"))
    state = state.withColumns({"low": low, "high": high}).withColumn("step", finer(F.col("high") - F.col("low"))).select("id", "length", "period", "n", "low", "high", "step", F.lit(False).alias("done"), F.lit(None).cast("int").alias("best"), F.lit(None).cast("double").alias("top"))
    while True:
        state = _stored(state)
        if state.where("not done").isEmpty():
            break
        tried = state.where("not done").select("id", "n", F.explode(F.sequence("low", "high", "step")).alias("p"))
        best = _best_ratio(tried, seqs).groupBy("id").agg(F.max_by("p", F.struct("ratio", (-F.col("p")).alias("q"))).alias("p"), F.max("ratio").alias("ratio"))
        moved = state.join(best, "id", "left")
        now = ~F.col("done")
        reach = 2 * F.col("step")
        state = moved.select("id", "length", "period", "n", F.when(now & (F.col("step") > 1), F.col("p") - reach).otherwise(F.col("low")).alias("low"), F.when(now & (F.col("step") > 1), F.col("p") + reach).otherwise(F.col("high")).alias("high"), F.when(now, finer(2 * reach)).otherwise(F.col("step")).alias("step"), (F.col("done") | (F.col("step") == 1)).alias("done"), F.when(now, F.col("p")).otherwise(F.col("best")).alias("best"), F.when(now, F.col("ratio")).otherwise(F.col("top")).alias("top"))
    own = _best_ratio(state.select("id", F.col("period").alias("p"), "n"), seqs).select("id", F.col("ratio").alias("own"))
    first = _stored(state.join(own, "id", "left").select("id", "length", F.when(F.col("top") > F.col("own"), F.col("best")).otherwise(F.col("period")).alias("period"), F.greatest("top", "own").alias("ratio")))
    multiples = first.where("period * 4 <= length").select("id", "length", F.explode(F.sequence(F.lit(2), F.expr("cast(floor(length / (2 * period)) as int)"))).alias("m"), "period")
    multiples = multiples.select("id", (F.col("m") * F.col("period")).alias("p"), F.bround(F.col("length") / (F.col("m") * F.col("period"))).cast("int").alias("n"))
    both = _stored(first.select("id", "period", "ratio").unionByName(_best_ratio(multiples, seqs).select("id", F.col("p").alias("period"), "ratio")).where(F.col("period") >= least))
    top = both.groupBy("id").agg(F.max("ratio").alias("top"), F.count("*").alias("k"))
    kept = both.join(top, "id").where((F.col("k") == 1) | (F.col("ratio") > F.greatest(F.lit(threshold), F.col("top") - 0.03)))
    return whole.unionByName(kept.select("id", "period"))


def split_alleles(v: DataFrame, threshold: float = 0.9, least: int = LEAST) -> DataFrame:
    """I27: a row for each long ALT of records with several ALTs, the shared ends taken off and GT 0/1; records with one ALT stay.

    ``allele`` numbers the rows of a record (``vid``), ``insertion`` tells their kind,
    ``own`` is the record's own ALT. ``*`` and changes of ``least`` bases or fewer give no row. Ends are shared if they are equal,
    short, or similar enough.
    """
    n = F.size("alt")
    rows = v.select("*", F.posexplode("alt").alias("__i", "__a"), n.alias("__n")).where("__a <> '*'")
    r, a = F.col("ref"), F.col("__a")
    lr, la = F.length(r), F.length(a)
    keep_left = lambda x, k: F.substring(x, F.lit(1), k)
    keep_right = lambda x, k: F.when(k > 0, F.right(x, k)).otherwise("")
    deletion = la < lr
    short, long = F.when(deletion, a).otherwise(r), F.when(deletion, r).otherwise(a)
    size = F.length(short)
    ratios = F.array(joins.lcs_ratio(short, keep_left(long, size)), joins.lcs_ratio(short, keep_right(long, size)))
    big = F.when(deletion, (lr > least) & (lr - la > least)).otherwise(la - lr > least)
    rows = rows.where((F.col("__n") == 1) | big).select("*", F.explode(F.array(ratios)).alias("__r"))
    left, right = F.get("__r", F.lit(0)), F.get("__r", F.lit(1))
    near = F.least(F.lit(threshold), 1 - 5 / lr)
    at_left = F.when(deletion, (la > 1) & ((a == keep_left(r, la)) | (la < 10) | (left > threshold))).otherwise((lr < 6) | (left > near))
    at_right = ~at_left & F.when(deletion, (la > 1) & (right > threshold)).otherwise(right > near)
    several = F.col("__n") > 1
    ref = F.when(at_left & deletion, keep_right(r, lr - la)).when(at_left, keep_right(r, F.lit(1))).when(at_right & deletion, keep_left(r, lr - la)).when(at_right, keep_left(r, F.lit(1))).otherwise(r)
    alt = F.when(at_left & deletion, keep_right(a, F.lit(1))).when(at_left, keep_right(a, la - lr + 1)).when(at_right & deletion, keep_left(r, F.lit(1))).when(at_right, keep_left(a, la - lr)).otherwise(a)
    moved = F.when(several & at_left, size - 1).otherwise(0)
    new = {"pos": F.col("pos") + moved, "ref": F.when(several, ref).otherwise(r), "alt": F.array(F.when(several, alt).otherwise(a)), "GT": F.when(several, "0/1").otherwise(F.col("GT"))}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in v.columns], F.col("__i").alias("allele"), F.when(several, ~deletion).otherwise(la > lr).alias("insertion"), a.alias("own"))


def extend_array(rows: DataFrame, chunks: DataFrame, threshold: float = 0.9, compat: bool = False, chunk: int = CHUNK) -> DataFrame:
    """``rows (key, ctg, start, stop, unit)`` with ``array_start, array_stop``: whole units on either side that are as similar as the threshold asks.

    Steps are tried eight at a time until every row has met its first unlike unit, or
    MOST_STEPS. ``compat``: the unlike unit is counted in.
    """
    size = F.length("unit")
    state = rows.select("key", "ctg", "start", "stop", "unit", F.lit(0).alias("l"), F.lit(0).alias("r"), F.lit(True).alias("ol"), F.lit(True).alias("or_"))
    for begin in range(1, MOST_STEPS + 1, 8):
        state = _stored(state)
        if state.where("ol or or_").isEmpty():
            break
        k = F.explode(F.sequence(F.lit(begin), F.lit(min(begin + 7, MOST_STEPS))))
        left = state.where("ol").select("key", "ctg", "unit", k.alias("k"), F.lit("l").alias("side"), "start", "stop").withColumn("s", F.col("start") - F.col("k") * size)
        right = state.where("or_").select("key", "ctg", "unit", k.alias("k"), F.lit("r").alias("side"), "start", "stop").withColumn("s", F.col("stop") + (F.col("k") - 1) * size)
        tries = left.unionByName(right).select(F.concat_ws(":", "key", "side", "k").alias("try"), "key", "side", "k", "ctg", "unit", F.col("s"), F.col("s").alias("start"), (F.col("s") + size).alias("end"))
        bases = ref_slice(tries, chunks, "try", chunk)
        scored = bases.select("key", "side", "k", "s", F.explode(F.array(joins.lcs_ratio("bases", "unit", threshold))).alias("ratio"))
        bad = scored.where((F.col("ratio") < threshold) | (F.col("s") < 0)).groupBy("key").agg(F.min(F.when(F.col("side") == "l", F.col("k"))).alias("bl"), F.min(F.when(F.col("side") == "r", F.col("k"))).alias("br"))
        met = state.join(bad, "key", "left")
        end = min(begin + 7, MOST_STEPS)
        state = met.select("key", "ctg", "start", "stop", "unit", F.when(F.col("ol"), F.coalesce("bl", F.lit(end + 1)) - 1).otherwise(F.col("l")).alias("l"), F.when(F.col("or_"), F.coalesce("br", F.lit(end + 1)) - 1).otherwise(F.col("r")).alias("r"), (F.col("ol") & F.col("bl").isNull()).alias("ol"), (F.col("or_") & F.col("br").isNull()).alias("or_"))
    extra = F.lit(1 if compat else 0)
    reach = lambda c, open_: (F.col(c) + F.when(F.col(open_), 0).otherwise(extra)) * size
    found = state.select("key", (F.col("start") - reach("l", "ol")).alias("array_start"), (F.col("stop") + reach("r", "or_")).alias("array_stop"))
    return rows.join(found, "key")


def local_match(rows: DataFrame, chunks: DataFrame, threshold: float = 0.9, compat: bool = False, chunk: int = CHUNK, step: int = STEP) -> DataFrame:
    """J16: where one period of a call (unique ``key``; ctg, pos, ref, alt string, insertion, period) lies beside it: ``start, stop, array_start, array_stop, ratio``.

    An insertion's first period is compared with the bases after its place and before it,
    split at points that are tried coarse to fine, at first a fortieth of the period or
    ``step`` bases apart; the first of the best points wins. A best ratio under UNLIKE at any round, or under the threshold at the end, gives no row. A
    deletion matches itself.
    """
    ins = rows.where("insertion").withColumn("p", F.col("period").cast("int"))
    near = ref_slice(ins.withColumns({"start": F.col("pos") - F.col("p"), "end": F.col("pos")}), chunks, "key", chunk, "before").drop("start", "end")
    near = ref_slice(near.withColumns({"start": F.col("pos"), "end": F.col("pos") + F.col("p")}), chunks, "key", chunk, "after").drop("start", "end")
    spare = F.length("alt") - F.bround(F.length("alt") / F.col("p")).cast("int") * F.col("p")
    after = F.when(spare > 0, F.concat(F.right("alt", spare), F.col("after"))).when(spare < 0, F.substring(F.col("after"), 1 - spare, F.length("after"))).otherwise(F.col("after"))
    near = _stored(near.select("key", "ctg", "pos", "p", "alt", "before", after.alias("after"), F.substring(F.col("alt"), F.lit(1), F.col("p")).alias("unit")))
    tail = lambda n: F.when(n > 0, F.right("before", n)).otherwise("")

    def scored(points: DataFrame) -> DataFrame:
        """``points (key, at, rank)`` with their ratios."""
        both = points.join(near, "key")
        made = F.when(F.col("at") == F.col("p"), F.col("after")).otherwise(F.concat(F.substring(F.col("after"), F.lit(1), F.col("at")), tail(F.col("p") - F.col("at"))))
        return both.repartition("key", "at").select("key", "at", "rank", F.explode(F.array(joins.lcs_ratio(made, "unit", UNLIKE))).alias("ratio"))

    step = F.greatest(F.floor(F.col("p") / 40).cast("int"), F.lit(step))
    points = near.select("key", F.posexplode(F.concat(F.sequence(F.lit(0), F.col("p") - 1, step), F.array("p"))).alias("rank", "at"))
    tried, steps = scored(points), near.select("key", "p", step.alias("step"))
    turn = 0
    while True:
        tried, turn = _stored(tried), turn + 1
        best = tried.groupBy("key").agg(F.max_by("at", F.struct("ratio", (-F.col("rank")).alias("r"))).alias("best"), F.max("ratio").alias("ratio"))
        steps = _stored(steps.join(best.where(F.col("ratio") >= UNLIKE), "key").select("key", "p", "step", "best", "ratio"))
        if steps.where("step > 1").isEmpty():
            break
        half = steps.withColumn("step", F.when(F.col("step") > 1, F.floor(F.col("step") / 2).cast("int")).otherwise(F.col("step")))
        ends = F.array(F.struct(F.greatest(F.lit(0), F.col("best") - F.col("step")).alias("at"), F.lit(0).alias("k")), F.struct(F.least(F.col("best") + F.col("step"), F.col("p")).alias("at"), F.lit(1).alias("k")))
        new = half.join(steps.select("key", F.col("step").alias("old")), "key").where("old > 1").select("key", F.explode(ends).alias("e")).select("key", "e.at", (F.lit(turn * 1_000_000) + F.col("e.k")).alias("rank"))
        new = new.groupBy("key", "at").agg(F.min("rank").alias("rank")).join(tried.select("key", "at"), ["key", "at"], "left_anti")
        tried, steps = tried.unionByName(scored(new)), half.select("key", "p", "step")
    hit = steps.where(F.col("ratio") >= threshold).select("key", "best", "ratio").join(near, "key")
    start = F.col("pos") - (F.col("p") - F.col("best"))
    unit = F.when(start != F.col("pos"), F.concat(tail(F.col("p") - F.col("best")), F.substring(F.col("alt"), F.lit(1), F.col("best")))).otherwise(F.col("unit"))
    found = hit.select("key", "ctg", start.alias("start"), (F.col("pos") + F.col("best")).alias("stop"), unit.alias("unit"), "ratio")
    own = rows.where("not insertion").select("key", "ctg", F.col("pos").alias("start"), (F.col("pos") + F.col("period")).alias("stop"), F.substring(F.col("ref"), F.lit(1), F.col("period").cast("int")).alias("unit"), F.lit(1.0).alias("ratio"))
    return extend_array(found.unionByName(own), chunks, threshold, compat, chunk).drop("unit", "ctg")


def unusable(v: DataFrame) -> DataFrame:
    """``(vid, reason)`` of records that ``indel_to_cnv`` leaves out: without alleles or a place, or with a genotype that is none."""
    gt = F.coalesce(F.col("GT").rlike(r"^([0-9]+|\.)([/|]([0-9]+|\.))*$"), F.lit(False))
    alleles = F.col("ref").isNotNull() & (F.size("alt") > 0) & ~F.exists("alt", lambda a: a.isNull())
    reason = F.when(F.col("ctg").isNull() | F.col("pos").isNull(), "no place").when(~F.coalesce(alleles, F.lit(False)), "no alleles").when(~gt, "no genotype")
    return v.select("vid", reason.alias("reason")).where("reason is not null")


def indel_to_cnv(v: DataFrame, chunks: DataFrame, threshold: float = 0.9, compat: bool = False, chunk: int = CHUNK, least: int = LEAST, step: int = STEP) -> DataFrame:
    """J13: copy-number calls ``cid, ctg, pos, end, start, stop, svtype, cndiff, period, svlen, gt, ratio`` of long insertions and deletions.

    ``v``: unique ``vid``, ctg, pos, end, ref, alt array, filter, GT. Opposite insertions
    are joined (F2), ALTs split (I27), periods found (J15) and matched beside the call
    (J16); of several the best stays (F6), and overlapping calls are folded (F3). Two ALTs
    of one kind with like periods count as one homozygous call. Deletions beyond LONGEST
    bases become calls as they are, save in ``compat``, where they do so only beside an ALT
    of the record that has a period; insertions beyond it give none. What lies apart from
    its call is not searched for. Records that can't be worked on give no row: ``unusable``
    tells which.
    """
    rows = filters.qualifying_sv(v.join(unusable(v).select("vid"), "vid", "left_anti"), least)
    rows = sequence.merge_opposite_phase(rows.select("vid", "ctg", "pos", "end", "ref", "alt", "GT"), chunks, chunk=chunk)
    calls = _stored(split_alleles(rows, threshold, least).withColumn("alt", F.get("alt", F.lit(0))).withColumn("key", F.concat_ws(":", "vid", "allele")))
    change = F.abs(F.length("alt") - F.length("ref"))
    total = A.allele_count("GT")
    seq = F.when(F.col("insertion"), F.col("alt")).otherwise(F.substring("ref", 2, 1 << 30))
    fits = (change >= least) & F.when(F.col("insertion"), F.length("alt") <= LONGEST).otherwise(change <= LONGEST)
    periods = _stored(find_periods(calls.where(fits).select(F.col("key").alias("id"), seq.alias("seq")), threshold, least, step).select(F.col("id").alias("key"), "period"))
    # two ALTs of one kind: of like periods the shorter one, and the longer ALT, as a homozygous call
    two = calls.join(periods, "key").select("vid", "allele", "insertion", "alt", "own", "period", "key")
    a, b = two.alias("a"), two.alias("b")
    same = a.join(b, (F.col("a.vid") == F.col("b.vid")) & (F.col("a.allele") < F.col("b.allele")) & (F.col("a.insertion") == F.col("b.insertion")) & (F.abs(F.col("a.period") / F.col("b.period") - 1) <= 0.05))
    shorter = F.least("a.period", "b.period")
    same = same.select(F.col("a.vid").alias("vid"), F.col("a.key").alias("ka"), F.col("b.key").alias("kb"), F.when(F.length("b.alt") > F.length("a.alt"), F.col("b.key")).otherwise(F.col("a.key")).alias("stays"), shorter.alias("p"), F.explode(F.array(joins.lcs_ratio(F.substring(F.col("a.own"), F.lit(1), shorter.cast("int")), F.substring(F.col("b.own"), F.lit(1), shorter.cast("int")), threshold))).alias("ratio"))
    same = _stored(same.where(F.col("ratio") > 1 - (1 - threshold) / 2))
    pairs = same.select("stays", F.explode(F.array("ka", "kb")).alias("key")).groupBy("key").agg(F.min("stays").alias("stays"))
    kept = calls.join(pairs, "key", "left").where("stays is null or stays = key").withColumn("GT", F.when(F.col("stays").isNotNull(), "1/1").otherwise(F.col("GT")))
    tried = kept.where("stays is null").join(periods, "key").unionByName(kept.where("stays is not null").join(same.select(F.col("stays").alias("key"), F.col("p").alias("period")).distinct(), "key"))
    tried = _stored(tried.drop("stays").withColumns({"call": F.col("key"), "key": F.concat_ws(":", "key", "period")}))
    matched = local_match(tried.select("key", "ctg", "pos", "ref", "alt", "insertion", "period"), chunks, threshold, compat, chunk, step)
    ranked = tried.join(matched, "key").withColumns({"matched": F.col("period").cast("long"), "rank": F.col("period").cast("long")})
    best = sequence.best_period(ranked.select("call", "key", "ratio", "matched", "rank", "vid", "ctg", "pos", "ref", "alt", "GT", "insertion", "period", "start", "stop", "array_start", "array_stop"), "call")
    covered = F.greatest(F.lit(0), F.least(F.col("pos") + F.length("ref"), F.col("array_stop")) - F.greatest("pos", "array_start"))
    copies = F.bround(F.when(F.col("insertion"), F.length("alt")).otherwise(covered) / F.col("period")).cast("int")
    sign = F.when(F.col("insertion"), 1).otherwise(-1)
    made = best.where(F.col("period") >= least).select(F.col("call").alias("cid"), "ctg", F.col("start").alias("pos"), F.col("stop").alias("end"), (F.col("array_start") + 1).alias("start"), (F.col("array_stop") + 1).alias("stop"), F.when(F.col("insertion"), "DUP").otherwise("DEL").alias("svtype"), (copies * total * sign).cast("int").alias("cndiff"), F.col("period").cast("int").alias("period"), F.col("period").cast("int").alias("svlen"), F.col("GT").alias("gt"), "ratio")
    huge = calls.where(~F.col("insertion") & (change > LONGEST))
    if compat:
        huge = huge.join(calls.join(periods.select("key").distinct(), "key").select("vid").distinct(), "vid", "left_semi")
    stop = F.col("pos") + F.length("ref")
    made = made.unionByName(huge.select(F.col("key").alias("cid"), "ctg", "pos", (stop - 1).alias("end"), (F.col("pos") + 1).alias("start"), stop.alias("stop"), F.lit("DEL").alias("svtype"), (-total).cast("int").alias("cndiff"), change.cast("int").alias("period"), change.cast("int").alias("svlen"), F.col("GT").alias("gt"), F.lit(1.0).alias("ratio")))
    return merge_output(made)


def _alleles(gt: str | None) -> list[int]:
    return [int(x) for x in (gt or ".").replace("|", "/").split("/") if x != "."]


def _either(a: str, b: str) -> str:
    """Allele by allele OR of two genotypes; if either misses one, the OR of the first alleles (0 where there is none) and a missing one."""
    one, two = _alleles(a), _alleles(b)
    if "." in (a or ".") or "." in (b or "."):
        return f"{(one or [0])[0] | (two or [0])[0]}/."
    return "|".join(str(x | y) for x, y in zip(one, two))


def extend_count(call: dict) -> dict:
    """I28: the copy change as the fewest changes of a whole number of periods that the array can hold; ``pos`` and ``end`` follow if it changes.

    ``svlen`` counts periods; n of them times the change of one allele, over a smaller
    change d, must be near a whole number (WHOLE) and fit into the range.
    """
    period, change = call["period"], call["cndiff"]
    if not change or not period:
        return call
    count = round(call["svlen"] / period)
    per_allele = abs(change // (sum(_alleles(call["gt"])) or 1))
    room = (call["stop"] - call["start"]) / period
    room = round(room) if room - round(room) < WHOLE else math.ceil(room) - 1
    fits = [d for d in range(1, per_allele + 1) if abs((n := count * per_allele / d) - round(n)) <= WHOLE and n <= room]
    if not fits or fits[0] == per_allele:
        return call
    size = round(count * per_allele / fits[0]) * period
    return call | {"cndiff": fits[0] if change > 0 else -fits[0], "svlen": size, "pos": call["start"], "end": call["start"] + size}


def merge_pair(a: dict, b: dict) -> dict | None | str:
    """J17: what becomes of two calls in a row: one call, ``drop`` if they cancel, or None if they stay apart.

    ===================== ============================== ====================================
    types                 condition                      result
    ===================== ============================== ====================================
    any                   common part under COMMON of    apart
                          the shorter range
    opposite              common part over COMMON of     the larger change's call with the sum,
                          both                           none if it is 0; otherwise apart
    DEL, DEL              longer has -2, or equal GT     the longer as it is
    DEL, DEL              common part over COMMON of     the longer, GT joined, sum of the
                          both                           changes but at most -2
    DUP, DUP              periods no whole multiple      apart
    DUP, DUP              equal alleles; or equal        the longer, GT joined, shorter period,
                          totals and neither is 1/1      sum of totals, then ``extend_count``
    ===================== ============================== ====================================
    """
    size_a, size_b = a["stop"] - a["start"], b["stop"] - b["start"]
    common = min(a["stop"], b["stop"]) - max(a["start"], b["start"])
    if common <= 0 or size_a <= 0 or size_b <= 0 or common / min(size_a, size_b) < COMMON:
        return None
    alike, longer, other = common / max(size_a, size_b) > COMMON, *((a, b) if size_a >= size_b else (b, a))
    if a["svtype"] != b["svtype"]:
        net = a["cndiff"] + b["cndiff"]
        if not alike:
            return None
        return "drop" if net == 0 else (a if abs(a["cndiff"]) > abs(b["cndiff"]) else b) | {"cndiff": net}
    if a["svtype"] == "DEL":
        if longer["cndiff"] == -2 or a["gt"] == b["gt"]:
            return longer
        return longer | {"gt": _either(a["gt"], b["gt"]), "cndiff": min(-2, a["cndiff"] + b["cndiff"])} if alike else None
    short, long = sorted((a["period"], b["period"]))
    if short <= 0 or abs(long / short - round(long / short)) > WHOLE:
        return None
    total, more = (x["cndiff"] * max(1, round(x["svlen"] / short)) for x in (longer, other))
    one, two = _alleles(a["gt"]), _alleles(b["gt"])
    if one == two or (total == more and [1, 1] not in (one, two)):
        return extend_count(longer | {"gt": _either(a["gt"], b["gt"]), "period": short, "svlen": short, "cndiff": total + more})
    return None


def merge_output(cnv: DataFrame) -> DataFrame:
    """left-to-right fold, by pos and cid, of calls ``cid, ctg, pos, end, start, stop, svtype (DEL or DUP), cndiff, period, svlen, gt``.

    Each call meets the last one kept on its contig. The order is cut where neither a
    range nor a pos reaches over, which no merge can cross; the parts stream through
    tasks that hold the last kept call only, so none is too large.
    """
    low, high = F.least("pos", "start"), F.greatest(F.col("pos") + 1, "stop")
    union = intervals.merge(cnv.select("ctg", low.alias("start"), high.alias("end"))).withColumn("__i", F.col("start"))
    placed = intervals.annotate_point(cnv, union, {"__i": "__island"})
    names = cnv.columns

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, last = None, None
        for batch in batches:
            kept: list[dict] = []
            for x in batch.to_dict("records"):
                here = (x["ctg"], x["__island"])
                if here != where and last is not None:
                    kept.append(last)
                    last = None
                where = here
                merged = None if last is None else merge_pair(last, x)
                if isinstance(merged, dict):
                    last = merged
                    continue
                if last is not None and merged is None:
                    kept.append(last)
                last = None if merged == "drop" else x
            yield pd.DataFrame(kept, columns=list(batch.columns))[names]
        if last is not None:
            yield pd.DataFrame([last])[names]

    sorted_rows = placed.repartition("ctg", "__island").sortWithinPartitions("ctg", "__island", "pos", "cid")
    return sorted_rows.mapInPandas(fold, cnv.schema)

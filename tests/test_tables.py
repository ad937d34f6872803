import gzip
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from strandframe.functions import alleles as A
from strandframe.operators import aggregates, filters, intervals, joins, sequence
from strandframe.sources import text


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def as_sets(iv):
    return {(r.ctg, x) for r in iv.collect() for x in range(r.start, r.end)}


def test_intervals_equal_sets_of_bases(spark):
    rng = random.Random(1)
    make = lambda n: [(rng.choice("ab"), s, s + rng.randint(0, 30)) for s in (rng.randint(0, 300) for _ in range(n))]
    a, b = (table(spark, make(60), "ctg string, start long, end long") for _ in range(2))
    contigs = table(spark, [("a", 320), ("b", 400), ("c", 10)], "ctg string, length long")
    assert as_sets(intervals.merge(a)) == as_sets(a)
    wide = sorted(intervals.merge(a).collect())
    def union(rows, d):
        out = []
        for c, s, e in sorted(rows):
            if out and out[-1][0] == c and s <= out[-1][2] + d:
                out[-1][2] = max(out[-1][2], e)
            else:
                out.append([c, s, e])
        return sorted(map(tuple, out))

    def pieces(rows, other):
        covered, out = as_sets(other), []
        for c, s, e in rows:
            free = [x for x in range(s, e) if (c, x) not in covered]
            starts = [x for x in free if x - 1 not in free]
            out += [(c, s, e, x, next(y for y in range(x, e + 1) if y == e or y not in free)) for x in starts]
        return sorted(out)

    for width in (1, 3, 16, 1000):
        for d in (0, 2, 9):
            assert sorted(map(tuple, intervals.merge(a, d, width).collect())) == union(map(tuple, a.collect()), d)
        kept = a.unionByName(a).selectExpr("*", "start as s", "end as e")
        got = intervals.subtract(kept, b, width).collect()
        assert sorted((r.ctg, r.s, r.e, r.start, r.end) for r in got) == pieces(2 * [tuple(r) for r in a.collect()], b)
        assert as_sets(intervals.gaps(a, intervals.whole_genome(contigs), width)) == {(r.ctg, x) for r in contigs.collect() for x in range(r.length)} - as_sets(a)
    for span in (1, 7, 50):
        narrow = intervals.running_max(intervals.merge(a), F.col("end"), "m", span=span)
        assert all(r.m == r.end for r in narrow.collect())
    assert all(x.end < y.start for x, y in zip(wide, wide[1:]) if x.ctg == y.ctg)
    assert as_sets(intervals.subtract(a, b, width=16)) == as_sets(a) - as_sets(b)
    genome = {(r.ctg, x) for r in contigs.collect() for x in range(r.length)}
    assert as_sets(intervals.complement(a, contigs)) == genome - as_sets(a)
    assert as_sets(intervals.cat_sort_merge([a, b])) == as_sets(a) | as_sets(b)
    assert as_sets(intervals.subtract(a, b.limit(0))) == as_sets(a)
    pairs = intervals.overlap_pairs(a, b, width=8).collect()
    want = sorted((x, y) for x in map(tuple, a.collect()) for y in map(tuple, b.collect()) if x[0] == y[0] and x[1] < x[2] and y[1] < y[2] and x[1] < y[2] and y[1] < x[2])
    assert sorted(((r.ctg, r.start, r.end), (r.ctg_b, r.start_b, r.end_b)) for r in pairs) == want


def test_nested_union_and_quirk(spark):
    iv = table(spark, [("a", 10, 50), ("a", 20, 30), ("a", 40, 60)], "ctg string, start long, end long")
    get = lambda df: sorted((r.start, r.end) for r in df.collect())
    assert get(intervals.load_merge(iv)) == [(10, 60)]
    assert get(intervals.load_merge(iv, compat=True)) == [(10, 30), (40, 60)]
    assert get(intervals.merge(table(spark, [("a", 1, 2), ("a", 5, 6)], "ctg string, start long, end long"), d=3)) == [(1, 6)]


def test_tiles_and_coverage(spark):
    contigs = table(spark, [("a", 25)], "ctg string, length long")
    assert [(r.pos, r.stop) for r in intervals.tile(contigs, 10).orderBy("pos").collect()] == [(1, 10), (11, 20), (21, 25)]
    reads = table(spark, [("a", 0, 12), ("a", 5, 12), ("a", -3, 2), ("a", 24, 90)], "ctg string, start long, end long")
    got = {r.tile: r for r in intervals.coverage_by_window(reads, contigs, 10, (1, 2)).collect()}
    depth = [sum(s <= x < e for _, s, e in map(tuple, reads.collect())) for x in range(25)]
    for t in range(3):
        own = depth[10 * t : 10 * t + 10]
        assert (got[t].bases, got[t].bases_1x, got[t].bases_2x) == (len(own), sum(d >= 1 for d in own), sum(d >= 2 for d in own))
        assert got[t].median_depth == sorted(own)[(len(own) - 1) // 2]


def test_region_strings(spark):
    v = table(spark, [("a", 9, 10), ("a", 10, 15), ("a", 30, 31), ("b", 10, 11)], "ctg string, pos long, end long")
    assert [r.pos for r in intervals.region_view(v, "a:11-20").collect()] == [10]
    assert intervals.region_view(v, "a").count() == 3
    assert intervals.outside_regions(v, v.limit(0).withColumnRenamed("pos", "start")).count() == 4


# Fixed values, see PEAKS.
LCS = [("ACGTACGT", "ACGTACGT", 1.0), ("", "", 1.0), ("ACGT", "", 0.0), ("AAAA", "CCCC", 0.0), ("ACGT", "ACGGT", 8 / 9), ("ACGT", "AGGT", 0.75), ("ACGTACGT" * 4, "CGTACGTA" * 4, 0.96875), ("AACCGGTT", "AACCGGTG", 0.875)]


def test_lcs_ratio_and_bound(spark):
    got = table(spark, LCS, "a string, b string, want double").select("a", "b", "want", joins.lcs_ratio("a", "b").alias("r"), joins.lcs_ratio("b", "a").alias("s"), joins.ratio_bound("a", "b").alias("top")).collect()
    assert all(r.r == pytest.approx(r.want) and r.s == r.r and r.top >= r.r - 1e-12 for r in got)


def test_similar_pairs_loses_none(spark):
    rng = random.Random(2)
    seqs = ["".join(rng.choices("ACGTN", k=rng.randint(0, 30))) for _ in range(60)]
    seqs += [s[:-1] + "A" for s in seqs if s]
    seqs += seqs[:7]
    rows = table(spark, [*enumerate(seqs), (None, "ACGT"), (999, None)], "id long, seq string")
    first = {x: i for i, x in reversed(list(enumerate(seqs)))}
    distinct = sorted(first.items(), key=lambda x: x[1])
    for t, shared in ((0.8, 3), (0.5, 1), (1.0, 2), (0.9, 3)):
        got = sorted((r.id, r.id_b, round(r.ratio, 9)) for r in joins.similar_pairs(rows, t, shared).collect())
        want = [(first[x], i, 1.0) for i, x in enumerate(seqs) if first[x] != i]
        for k, (x, i) in enumerate(distinct):
            for y, j in distinct[k + 1 :]:
                r = 2 * joins._lcs(x, y) / (len(x) + len(y))
                want += [(i, j, round(r, 9))] if r >= t else []
        assert got == sorted(want)


def test_similar_long_strings_meet_on_segments(spark):
    rng = random.Random(12)
    base = ["".join(rng.choices("ACGT", k=rng.choice([180, 230, 300]))) for _ in range(25)]

    def edited(s, k):
        s = list(s)
        for _ in range(k):
            at = rng.randrange(len(s))
            s[at : at + rng.randint(0, 1)] = rng.choice(["", "A", "T"])
        return "".join(s)

    seqs = base + [edited(s, rng.randint(1, 9)) for s in base * 2] + ["ACGT" * 50, "ACGT" * 51, "short", "A" * 100]
    rows = table(spark, list(enumerate(seqs)), "id long, seq string")
    for t in (0.95, 0.98):
        got = {(r.id, r.id_b) for r in joins.similar_pairs(rows, t, longest_short=50).collect()}
        want = {(i, j) for i, x in enumerate(seqs) for j, y in enumerate(seqs) if i < j and joins.similarity(x, y) >= t}
        assert got == want and len(want) > 20


def test_similar_strings_with_a_common_beginning(spark, monkeypatch):
    """Of strings that share a segment only those go on that can be alike, also where one segment is dealt to several tasks, and none of these is lost."""
    monkeypatch.setattr(joins, "_CELL", 530)
    rng = random.Random(14)
    some = lambda n, letters="ACGT": "".join(rng.choices(letters, k=n))
    begin = some(63)
    seqs = [begin + some(rng.randint(53, 55)) for _ in range(1100)]

    def edited(s):
        s = list(s)
        for _ in range(rng.randint(1, 4)):
            s[rng.randrange(len(s))] = rng.choice(["", "A", "GT"])
        return "".join(s)

    seqs = [*dict.fromkeys(seqs + [edited(s) for s in seqs[:100]] + [edited(some(20, "äöü漢 字") + begin) for _ in range(3)])]
    rows = table(spark, list(enumerate(seqs)), "id long, seq string")
    assert joins._segment_pairs(rows, 0.96, 32).count() < 5000  # 620,000 where all that share a segment go on
    got = {(r.id, r.id_b): r.ratio for r in joins.similar_pairs(rows, 0.96, longest_short=32).collect()}
    pairs = [(i, j) for i in range(len(seqs)) for j in range(i + 1, len(seqs))]
    ratios = joins._similarities([seqs[i] for i, _ in pairs], [seqs[j] for _, j in pairs], 0.96)
    assert got == {p: r for p, r in zip(pairs, ratios) if r >= 0.96} and len(got) > 50


def test_similar_long_strings_of_any_letters_and_threshold(spark):
    """Few segments and many, two bits of letters that are alike, lengths about the limit, ids that are texts."""
    rng = random.Random(15)
    for letters, t, longest in (("AE", 0.97, 20), ("abcdefgh", 0.9, 24), ("ACGT", 0.8, 30), ("ACGT", 0.6, 9), ("ACGT", 0.7, 8)):
        seqs = []
        for _ in range(25):
            s = "".join(rng.choices(letters, k=rng.choice([longest - 2, longest + 1, 33, 60, 140])))
            seqs += [s, s[1:] + rng.choice(letters), rng.choice(letters) + s[: len(s) // 2] + s[len(s) // 2 + 1 :], s + "".join(rng.choices(letters, k=len(s) // 9))]
        seqs = [*dict.fromkeys(seqs)]
        rows = table(spark, [(f"s{i:03}", s) for i, s in enumerate(seqs)], "id string, seq string")
        got = {(r.id, r.id_b) for r in joins.similar_pairs(rows, t, longest_short=longest).collect()}
        want = {(f"s{i:03}", f"s{j:03}") for i, x in enumerate(seqs) for j, y in enumerate(seqs) if i < j and joins.similarity(x, y, t) >= t}
        assert got == want and len(want) > 25


def test_similarity_with_a_threshold():
    rng = random.Random(13)
    for _ in range(300):
        a = "".join(rng.choices("ACGT", k=rng.randint(0, 90)))
        b = "".join(c for c in a if rng.random() > 0.1) if rng.random() < 0.7 else "".join(rng.choices("ACGT", k=rng.randint(0, 90)))
        exact = joins.similarity(a, b)
        for t in (0.6, 0.9, 0.95, 1.0):
            assert joins.similarity(a, b, t) == (exact if exact >= t - 1e-12 else 0.0)
    a = "".join(rng.choices("ACGT", k=6000))  # several blocks
    b = a[:2000] + a[2100:5000] + "ACGT" * 20 + a[5000:]
    assert joins.similarity(a, b, 0.95) == joins.similarity(a, b) > 0.95 and joins.similarity(a, b, 0.999) == 0.0


# Similarities and peaks as published with the tool whose results these functions must equal.
PEAKS = [([0.0, 0.5, 1.0, 0.5, 0.0], 1, [2]), ([0.0, 0.95, 0.0, 0.0, 0.0, 0.97, 0.0], 2, [1, 5]), ([0.0, 0.95, 0.0, 0.97, 0.0], 3, [3]), ([0.0, 0.5, 0.0, 0.6, 0.0], 1, []), ([0.0, 0.95, 0.95, 0.0], 1, [1]), ([1.0, 0.9, 0.8], 1, []), ([0.8, 0.9, 1.0], 1, []), ([0.3, 0.5, 0.6, 0.95, 0.7, 0.6, 0.5, 0.96, 0.4, 0.3], 2, [3, 7]), ([], 1, []), ([0.0, 1.0], 1, []), ([0.95, 0.95, 0.0], 1, []), ([0.0, 0.95, 0.95], 1, []), ([0.0, 0.3, 0.95, 0.95, 0.95, 0.3, 0.0], 1, [3]), ([0.0, 0.95, 0.0, 0.95, 0.0], 3, [1])]


def test_find_peaks(spark):
    for distance in (1, 2, 3):
        rows = [(k, s) for k, (s, d, _) in enumerate(PEAKS) if d == distance]
        got = {r.id: list(r.peaks) for r in sequence.find_peaks(table(spark, rows, "id long, series array<double>"), distance, 0.9).collect()}
        assert got == {k: p for k, (_, d, p) in enumerate(PEAKS) if d == distance}


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def lit(x):
    return F.array(*map(F.lit, x)) if isinstance(x, list) else F.lit(x)


def test_alleles(spark):
    r = one(spark, a=A.trim_pair(lit("CAA"), lit("CA")), b=A.trim_pair(lit("ACGT"), lit("AGT")), c=A.trim_pair(lit("A"), lit("A")), d=A.trim_pair(lit("AT"), lit("")))
    assert tuple(r.a) == ("CA", "C") and tuple(r.b) == ("AC", "A") and tuple(r.c) == ("A", "A") and tuple(r.d) == ("AT", "")
    r = one(spark, a=A.combine_alleles(lit("A"), lit("C"), lit("AT"), lit("A")), b=A.combine_alleles(lit("ATT"), lit("A"), lit("A"), lit("G")), m=A.allele_map(lit("AT"), lit(["A", "G"]), lit("ATC"), lit(["T", "AC"])), k=A.match_alleles(lit("A"), lit(["C"]), lit("AT"), lit(["CT", "A"])))
    assert (r.a.ref, r.a.alts) == ("AT", ["CT", "A"]) and (r.b.ref, r.b.alts) == ("ATT", ["A", "GTT"]) and r.m == [0, 2, -1] and r.k
    r = one(spark, two=A.two_best_alts(lit([9, 5, 4, 3]), lit(3)), none=A.two_best_alts(F.lit(None).cast("array<int>"), lit(3)), few=A.two_best_alts(lit([0, 1, 2]), lit(2)))
    assert (r.two, r.none, r.few) == ([0, 3, 2], [0, 1, 2], [0, 1, 2])
    r = one(spark, g=A.genotypes(lit(3)), i=A.genotype_index(lit(1), lit(2)), s=A.subset_g(lit([0, 1, 2, 3, 4, 5]), lit([0, 2]), lit(2)), h=A.subset_g(lit([7, 8, 9]), lit([0, 2]), lit(2)), t=A.subset_alleles(lit("ACC"), lit(["AC", "ACCCC"]), lit([0, 2])), gt=A.remap_gt(lit("2/1"), lit([0, 2])))
    assert [(x.i, x.j) for x in r.g] == [(0, 0), (0, 1), (1, 1), (0, 2), (1, 2), (2, 2)] and r.i == 4
    assert r.s == [0, 3, 5] and r.h == [7, 9] and (r.t.ref, r.t.alts) == ("A", ["ACC"]) and r.gt == "1/0"


def brute_diploid(pl, n):
    gts = [(i, j) for j in range(n + 1) for i in range(j + 1)]
    best = min((pl[k], j, i) for k, (i, j) in enumerate(gts) if k)
    i, j = best[2], best[1]
    keep = {0, i, j}
    if i in (0, j):
        rest = min((pl[k], y, x) for k, (x, y) in enumerate(gts) if k and (x, y) != (i, j) and (x in (0, j) or y in (0, j)))
        keep = {0, rest[2], j, rest[1]}
    return sorted(keep)


def test_diploid_alleles(spark):
    rng = random.Random(3)
    rows = [(n, [rng.randint(0, 9) for _ in range((n + 1) * (n + 2) // 2)]) for n in (2, 3, 4) for _ in range(40)]
    got = table(spark, rows, "n int, pl array<int>").select("n", "pl", A.diploid_alleles("pl", "n").alias("k"), A.diploid_alleles("pl", F.col("n") + 1).alias("bad")).collect()
    assert all(r.k == brute_diploid(r.pl, r.n) and r.bad is None for r in got)


def test_likelihoods_and_depths(spark):
    big = A.NO_PL
    r = one(spark, j=A.join_pl(lit([0, 30]), lit([40, 0])), u=A.join_pl(lit([0, 5, big]), lit([0, big, 9])), ad=A.join_ad(lit([1, 2]), lit([3, 4])), alone=A.join_ad(lit([1, 2]), F.lit(None).cast("array<int>"), lit(9)), rpa=A.join_rpa(lit([4, -1]), lit([3, 5])), none=A.join_rpa(lit([4, -1]), lit([3, -1])))
    assert (r.j.pl, r.j.gq) == ([40, 0, 30], 30) and r.ad == [4, 6] and r.alone == [7, 2] and r.rpa == [4, 5] and r.none is None
    assert r.u.pl == [0, 5, 50, 9, 14, 50] and r.u.gq == 5
    r = one(spark, a=A.add_nonref_pl(lit([1, 2, 3]), lit(2), lit(2)), c=A.add_nonref_pl(lit([1, 2, 3]), lit(2), lit(2), True), h=A.add_nonref_pl(lit([1, 2]), lit(2), lit(1)), d=A.add_nonref_ad(lit([3, 4]), lit(9)))
    assert r.a == [1, 2, 3, 100, 100, 100] and r.c == [1, 2, 100, 3, 100, 100] and r.h == [1, 2, 100] and r.d == [3, 4, 2]
    r = one(spark, g=A.join_gt(lit(True), lit(True), lit(False), lit(True))["gt"], h=A.join_gt(lit(False), lit(True), lit(False), lit(False))["gt"], o=A.gt_or(lit("0|1"), lit("1|0")), x=A.gt_or(lit("1/."), lit("0|1")), n=A.allele_count(lit("1|2")), p=A.ploidy_of_gt(lit("0/1/1")), z=A.homref_gt(lit(2)))
    assert (r.g, r.h, r.o, r.x, r.n, r.p, r.z) == ("1|2", "0/1", "1|1", "1/.", 3, 3, "0/0")


def test_text_fields(spark):
    r = one(spark, i=A.parse_info(lit("AF=0.5,1;STR;RU=AC")), d=A.parse_info(lit(".")), h=A.parse_header(lit('##INFO=<ID=AF,Number=A,Description="a, b">')), g=A.parse_rg(lit("@RG\\tID:x\\tSM:a:b")), e=A.edge_distance(lit(5), lit(10), lit(20)), s=A.str_end(lit(9), lit("AC"), lit([3, 4])), k=A.added_alts(lit(["C", "<NON_REF>", "G"]), lit([".", ".", "."])), f=A.added_alts(lit(["C", "G"]), lit([".", "0.1"])))
    assert r.i == {"AF": "0.5,1", "STR": None, "RU": "AC"} and r.d == {} and r.h["Description"] == "a, b" and r.g == {"ID": "x", "SM": "a:b"}
    assert (r.e, r.s, r.k, r.f) == (5, 16, [0, 1, 2], [0, 2])
    with pytest.raises(Exception, match="without a colon"):
        one(spark, g=A.parse_rg(F.concat(lit("@RG\tbroken"), F.col("id").cast("string"))))


def test_hybrid_filter_rules(spark):
    rows = [([0, 40, 50], [0, 40, 50], [1, 0], None), ([0, 10, 50], [0, 40, 50], [5, 5], None), ([0, 40, 50], [0, 40, 50], [5, 5], None), ([0, 40, 50], [40, 0, 50], [5, 5], True), ([0, 40, 50], [40, 0, 50], [5, 5], None), ([5, 0, 90], [40, 0, 50], [5, 5], None), (None, None, [5], None), ([1, 2, 3], [0, 1, 2], [9], None)]
    got = [r.filter for r in filters.hybrid_filter(table(spark, rows, "LPL array<int>, SPL array<int>, LAD array<int>, STR boolean").coalesce(1)).collect()]
    assert got == ["longread_lowdepth", "longread_lowconf", "same_gt", "longread_str", "PASS", "longread_lowconf", "longread_lowconf", None]


def test_joins(spark):
    v = table(spark, [("a", 5, 0, "x"), ("a", 5, 1, "y"), ("b", 1, 2, "z")], "ctg string, pos long, file_order long, id string")
    d = table(spark, [("a", 5, 0, "d"), ("c", 9, 1, "e")], "ctg string, pos long, file_order long, id string")
    got = sorted((r.ctg, r.v and r.v.id, r.d and r.d.id) for r in joins.cogroup_pos({"v": v, "d": d}).collect())
    assert got == [("a", "x", "d"), ("b", "z", None), ("c", None, "e")] and joins.lost_rows(v).first().lost == 1
    raw = table(spark, [(1, "a", 5, "AT", ["A", "GT"]), (2, "z", 5, "A", ["C"])], "vid long, ctg string, pos long, ref string, alt array<string>")
    pop = table(spark, [("a", 5, "ATT", ["AT", "C"], [3, 9]), ("a", 5, "A", ["G"], [4])], "ctg string, pos long, ref string, alt array<string>, AC array<int>")
    assert {r.vid: list(r.pop_AC) for r in joins.transfer_annotations(raw, pop, "vid", {"AC": "sum"}).collect()} == {1: [3, 4], 2: [None]}
    known = table(spark, [("a", 5, "A", ["G"], "rs1")], "ctg string, pos long, ref string, alt array<string>, id string")
    assert {r.vid: r.known_id for r in joins.annotate_ids(raw, known, "vid").collect()} == {1: "rs1", 2: None}
    u = joins.concat_dedup([raw, raw.unionByName(raw.withColumn("pos", F.lit(6).cast("long")))])
    assert u.where("source = 0").count() == 2 and u.where("source = 1").count() == 2
    groups = table(spark, [("1", {"SM": "s"}), ("2", {"ID": "x"})], "rg string, tags map<string,string>")
    assert tuple(joins.validate_one_sample(groups).first()) == (1, 1, False)
    assert [r.ctg for r in joins.check_contigs(table(spark, [("a", 1), ("b", 2)], "ctg string, length long"), table(spark, [("a", 1), ("b", 3)], "ctg string, length long")).collect()] == ["b"]


def test_opposite_phase_over_the_edges_of_bins(spark):
    """Runs of rows within bins, at their edges and over several of them, held against a fold; the calls are read once."""
    rng = random.Random(16)
    bases = {c: "".join(rng.choices("ACGT", k=700)) for c in "ab"}
    rows = []
    for ctg in "ab":
        at = rng.randint(0, 5)
        while at < 640:
            ref = bases[ctg][at : at + rng.choice([1, 1, 1, 2, 4])]
            alt = [ref[0] + "".join(rng.choices("ACGT", k=rng.randint(0, 4)))] + ["T"] * (rng.random() < 0.1)
            rows.append((f"v{rng.random()}", ctg, at, at + len(ref), ref, alt, rng.choice(["1|0", "0|1", "1|0", "0|1", "0/1", None])))
            at += rng.choice([0, 1, 2, 5, 9, 10, 11, 12, 40])
    want, gap = {}, 10
    for ctg in "ab":
        run, last = [], None
        for r in [*sorted((r for r in rows if r[1] == ctg), key=lambda r: (r[2], r[0])), None]:
            meets = r and last and len(r[5]) == len(last[5]) == 1 and {r[6], last[6]} == {"1|0", "0|1"} and r[2] - last[2] <= gap and len(last[4]) <= min(len(r[5][0]), len(last[5][0]))
            if not meets:
                for x, y in zip(run[::2], [*run[1::2], None]):
                    between = bases[ctg][x[3] : y[2] + 1] if y else ""
                    ref = x[4] + between
                    want[x[0]] = (x[2], ref, [x[5][0] + between, ref[:-1] + y[5][0]], "1|1") if y else (x[2], x[4], x[5], x[6])
                run = []
            run, last = [*run, r], r
    chunks = table(spark, [(c, k, s[16 * k : 16 * k + 16]) for c, s in bases.items() for k in range(44)], "ctg string, chunk long, seq string")
    v = table(spark, rows, "vid string, ctg string, pos long, end long, ref string, alt array<string>, GT string")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    for width in (3, 16, 64, 1 << 22):
        seen.value = 0
        got = sequence.merge_opposite_phase(v.withColumn("ref", counted("ref")), chunks, gap, 16, width).collect()
        assert {r.vid: (r.pos, r.ref, r.alt, r.GT) for r in got} == want and len(got) == len(want) < len(rows)
        assert seen.value == len(rows)  # twice as many where what follows works them out again


def test_merge_opposite_phase(spark):
    chunks = table(spark, [("a", 0, "NNNNNNNNNNACGTCTCAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA")], "ctg string, chunk long, seq string")
    rows = [(1, "a", 10, 11, "A", ["ATTT"], "1|0"), (2, "a", 14, 15, "C", ["CGG"], "0|1"), (3, "a", 16, 17, "C", ["CA"], "1|0"), (4, "a", 40, 41, "C", ["CA"], "0|1"), (5, "b", 41, 42, "C", ["CA"], "1|0"), (6, "c", 1, 4, "CAA", ["C"], "1|0"), (7, "c", 2, 3, "A", ["AT"], "0|1"), (8, "c", 3, 4, "A", ["AT", "AG"], "1|0")]
    v = table(spark, rows, "vid long, ctg string, pos long, end long, ref string, alt array<string>, GT string")
    got = {r.vid: (r.ref, r.alt, r.GT) for r in sequence.merge_opposite_phase(v, chunks).collect()}
    kept = {r[0]: (r[4], r[5], r[6]) for r in rows if r[0] > 2}
    assert got == {1: ("ACGTC", ["ATTTCGTC", "ACGTCGG"], "1|1"), **kept}


def test_reads(spark):
    reads = table(spark, [("ACGTN", "IIII!"), ("", "")], "seq string, qual string")
    assert {r.kmer: r.n for r in aggregates.kmer_count(reads, 3).collect()} == {"ACG": 2}
    assert [(r.cycle, r.mean_quality) for r in aggregates.mean_quality_by_cycle(reads).orderBy("cycle").collect()] == [(1, 40.0), (2, 40.0), (3, 40.0), (4, 40.0), (5, 0.0)]
    dup = table(spark, [(1, "k", 5), (2, "k", 9), (3, "k", 9), (4, "l", 1)], "read_id long, mate string, score int")
    assert sorted(r.read_id for r in aggregates.mark_duplicates(dup, ("mate",), "remove").collect()) == [2, 4]
    named = table(spark, [("b", "k", 9), ("a", "k", 9), ("c", None, 1), ("d", None, 2), ("e", "l", None), ("f", "l", 0)], "read_id string, mate string, score int")
    assert sorted(r.read_id for r in aggregates.mark_duplicates(named, ("mate",), "remove").collect()) == ["a", "c", "d", "f"]
    pile = table(spark, [("k", "ACG", "I+I"), ("k", "ATG", "I5I"), ("k", "AT", "I!"), ("l", "A", "I"), (None, "A", "I")], "mate string, seq string, qual string")
    assert [(r.mate, r.reads, r.seq, r.qual) for r in aggregates.consensus(pile, ("mate",)).collect()] == [("k", 3, "ATG", "]+]")]
    p = aggregates.ploidy(table(spark, [("1", 100, 100), ("1", 100, 100), ("X", 100, 100), ("Y", 100, 50), ("M", 100, 900)], "ctg string, length long, mapped long"), ["1"])
    assert {r.ctg: r.ploidy for r in p.collect()} == {"1": "2", "X": "1", "Y": "Unknown", "M": "3+"}
    assert aggregates.sex(p, "X", "Y").first().sex == "Unknown"


VCF = """##fileformat=VCFv4.2
##contig=<ID=b,length=50>
##contig=<ID=a>
##INFO=<ID=AC,Number=A,Type=Integer,Description="x, y">
##INFO=<ID=STR,Number=0,Type=Flag,Description="s">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS
a\t5\t.\tA\tC,G\t10.5\tPASS\tAC=1,2;STR\tGT:PL\t0/1:1,2,3
b\t2\trs\tAT\t.\t.\t.\t.\tGT\t.
"""


def test_vcf_round_trip(spark, tmp_path):
    path = tmp_path / "x.vcf.gz"
    path.write_bytes(gzip.compress(VCF.encode()))
    v, header = text.read_vcf(spark, str(path))
    rows = v.orderBy("file_order").collect()
    assert (rows[0].pos, rows[0].end, rows[0].alt, rows[0].qual, rows[0].GT) == (4, 5, ["C", "G"], 10.5, "0/1") and rows[1].alt == [] and rows[1].filter == []
    assert {r.ctg: r.length for r in text.header_contigs(header).collect()} == {"b": 50, "a": None}
    assert [r.id for r in text.header_fields(header).collect()] == ["AC"] and text.header_value(header, "fileformat").first().value == "VCFv4.2"
    assert [r.x for r in v.select(text.sample_array("PL").alias("x")).orderBy(F.size("x").desc()).collect()][0] == [1, 2, 3]
    contigs = text.header_contigs(header).withColumn("ctg_idx", F.monotonically_increasing_id())
    text.write_vcf(v, header, contigs, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out/records")).collect()]
    assert sorted(lines) == sorted(x for x in VCF.splitlines() if not x.startswith("#"))
    text.write_variants_parquet(v, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).where("ctg = 'a'").count() == 1


def test_other_sources(spark, tmp_path):
    put = lambda name, body: (tmp_path / name).write_text(body) and str(tmp_path / name)
    bed = text.read_bed(spark, put("a.bed", "#c\ntrack x\nchr20\t1\t100\textra\n\nshort\t1\n"))
    assert [tuple(r) for r in bed.collect()] == [("chr20", 1, 100)]
    with pytest.raises(Exception, match="fewer than four"):
        text.read_bed4(spark, put("b.bed", "a\t1\t2\n")).collect()
    assert text.read_contigs(spark, put("r.fai", "chr20\t260001\t7\t60\t61\n")).first().length == 260001
    fasta = text.read_fasta(spark, put("r.fa", ">c1 desc\nACGT\nACG\n>c2\nTT\n"), chunk=3)
    assert sorted(map(tuple, fasta.collect())) == [("c1", 0, "ACG"), ("c1", 1, "TAC"), ("c1", 2, "G"), ("c2", 0, "TT")]
    want = table(spark, [(1, "c1", -2, 5), (2, "c1", 2, 7), (3, "c2", 1, 1), (4, "zz", 0, 9)], "vid long, ctg string, start long, end long")
    assert {r.vid: r.bases for r in text.ref_slice(want, fasta, "vid", chunk=3).collect()} == {1: "ACGTA", 2: "GTACG", 3: "", 4: ""}
    model = text.read_repeat_model(spark, put("m.tsv", "AC\t15\t10\t10\t13:27.5,14:9.75\n")).first()
    assert model.cost == {13: 27.5, 14: 9.75}
    fastq = tmp_path / "x.fq.gz"
    fastq.write_bytes(gzip.compress(b"@r1 x\nACGT\n+\n@III\n@r2\nGG\n+\nII\n"))
    assert sorted(map(tuple, text.read_fastq(spark, str(fastq)).collect())) == [("r1", "ACGT", "@III"), ("r2", "GG", "II")]
    p = table(spark, [("a", 2.0, "2")], "ctg string, normalized_coverage double, ploidy string")
    text.write_ploidy_json(p, spark.createDataFrame([Row(sex="male")]), str(tmp_path / "p"))
    back = text.read_ploidy_json(spark, str(tmp_path / "p")).first()
    assert back.sex == "male" and back.contigs["a"].ploidy == "2"


def test_filters_hold_on_streams(spark, tmp_path):
    rows = table(spark, [("a", 1, ["PASS"]), ("b", 2, ["low"]), ("c", 3, [])], "ctg string, pos long, filter array<string>")
    rows.write.parquet(str(tmp_path / "in"))
    stream = filters.filter_pass(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("passed").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.ctg for r in spark.table("passed").collect()) == ["a", "c"]

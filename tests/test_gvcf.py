import random

from pyspark.sql import functions as F

from strandframe.operators.normalise import left_align
from strandframe.plans import gvcf

SCHEMA = "vid long, ctg string, pos long, end long, ref string, alt array<string>, GT string, GQ int, DP int, PL array<int>, AD array<int>"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def test_combine(spark):
    n = gvcf.NON_REF
    g = rows(
        spark,
        (1, "a", 0, 100, "A", [n], "0/0", 50, 9, [0, 1, 2], None),
        (2, "a", 100, 104, "ACGT", ["A", n], "0/1", 50, 9, [1, 0, 2, 3, 4, 5], [1, 2, 0]),
        (3, "a", 110, 120, "G", [n], "0/0", 50, 9, [0, 1, 2], None),
        (4, "a", 120, 122, "GT", ["G", n], "0/1", 50, 9, None, None),
    )
    calls = rows(spark, (1, "a", 10, 12, "AC", ["A"], "0/1", 40, 9, [9, 0, 9], [4, 3]), (2, "a", 99, 100, "C", ["T"], "1/1", 40, 9, None, None), (3, "a", 100, 101, "A", ["G"], "0/1", 40, 9, [9, 0, 9], [4, 5]))
    chunks = spark.createDataFrame([("a", 0, "ACGTACGTACGTTTT")], "ctg string, chunk long, seq string")
    got = sorted((r.pos, r.end, r.ref, tuple(r.alt), r.GT, r.GQ) for r in gvcf.gvcf_combine(g, calls, chunks).collect())
    assert got == [
        (0, 10, "A", (n,), "0/0", 50),
        (10, 12, "AC", ("A", n), "0/1", 40),
        (12, 99, "T", (n,), "0/0", 50),
        (99, 100, "C", ("T", n), "1/1", 40),
        (100, 101, "A", ("G", n), "0/1", 40),
        (101, 110, "C", (n,), "0/0", 15),
        (110, 120, "G", (n,), "0/0", 50),
        (120, 122, "GT", ("G", n), "0/0", 50),
    ]
    one = gvcf.add_nonref(calls).where("pos = 10").first()
    assert one.PL == [9, 0, 9, 100, 100, 100] and one.AD == [4, 3, 2]
    back = gvcf.gvcf_to_calls(gvcf.add_nonref(calls)).where("pos = 10").first()
    assert (back.alt, back.PL, back.AD) == (["A"], [9, 0, 9], [4, 3])


def test_blocks_are_cut_by_the_calls_that_begin_in_them(spark):
    n = gvcf.NON_REF
    block = lambda k, s, e: (k, "a", s, e, "A", [n], "0/0", 50, 9, [0, 1, 2], None)
    call = lambda k, s, e: (k, "a", s, e, "A", ["C"], "0/1", 40, 9, None, None)
    get = lambda g, c: sorted((r.pos, r.end) for r in gvcf.split_blocks(rows(spark, *g), rows(spark, *c)).collect())
    assert get([block(1, 50, 200), block(2, 200, 400)], [call(1, 100, 300)]) == [(50, 100), (200, 400)]
    assert get([block(1, 0, 100)], [call(1, 10, 40), call(2, 20, 60), call(3, 50, 70), call(4, 0, 1)]) == [(1, 10), (40, 50), (70, 100)]
    assert get([block(1, 0, 100), block(2, 100, 200)], []) == [(0, 100), (100, 200)]

    def brute(blocks, calls):
        """The pieces, taken one call after another."""
        out = []
        for _, _, s, e, *_ in blocks:
            at = s
            for a, b in sorted((c[2], c[3]) for c in calls):
                if at <= a < e:
                    out += [(at, a)] if at < a else []
                    at = b
            out += [(at, e)] if at < e else []
        return sorted(out)

    rng = random.Random(4)
    edges = sorted(rng.sample(range(2000), 40))
    blocks = [block(k, s, e) for k, (s, e) in enumerate(zip(edges, edges[1:])) if k % 5]
    calls = [call(k, s, s + rng.randint(1, 60)) for k, s in enumerate(rng.choices(range(2000), k=120))]
    assert get(blocks, calls) == brute(blocks, calls)


def test_trim_added_alts(spark):
    n = gvcf.NON_REF
    v = spark.createDataFrame([(1, "ACC", ["AACC", "ACCC"], [".", "0.1"], [1, 2, 3], [0, 1, 2, 3, 4, 5]), (2, "A", ["C"], ["0.2"], [1, 2], [0, 1, 2]), (3, "ATT", ["CTT", n, "GTT"], None, [1, 2, 3, 4], list(range(10))), (4, "A", [n, "T"], None, [1, 2, 3], [7, 8, 9])], "vid long, ref string, alt array<string>, AF array<string>, AD array<int>, PL array<int>")
    got = {r.vid: (r.ref, r.alt, r.AF, r.AD, r.PL) for r in gvcf.trim_added_alts(v).collect()}
    assert got == {1: ("A", ["AC"], ["0.1"], [1, 3], [0, 3, 5]), 2: ("A", ["C"], ["0.2"], [1, 2], [0, 1, 2]), 3: ("A", ["C", n], None, [1, 2, 3], [0, 1, 2, 3, 4, 5]), 4: ("A", [n], None, [1, 2], [7, 8])}


def test_regions_and_cnv(spark):
    contigs = spark.createDataFrame([("a", 5000)], "ctg string, length long")
    v = spark.createDataFrame([("a", 2000, 2001, [0, 40, 50], [40, 0, 50], [5, 5], None), ("a", 3500, 3501, [0, 40, 50], [0, 40, 50], [5, 5], None)], "ctg string, pos long, end long, LPL array<int>, SPL array<int>, LAD array<int>, STR boolean")
    low = spark.createDataFrame([("a", 2900, 3000), ("a", 4900, 5000)], "ctg string, start long, end long")
    assert sorted((r.start, r.end) for r in gvcf.difference_regions(v, low, contigs).collect()) == [(1000, 5000)]
    cnv = spark.createDataFrame([(1, "a", 0, 100, 1, ["PASS"]), (2, "a", 0, 100, 2, ["PASS"]), (3, "a", 500, 600, 1, []), (4, "a", 0, 100, 3, ["PASS"]), (5, "a", 0, 9, 1, ["bad"]), (6, "a", 50, 50, 0, [])], "cid long, ctg string, pos long, end long, CN int, filter array<string>")
    conv = spark.createDataFrame([(10, "a", 20, 21, -1, 20, 90, []), (11, "a", 20, 21, None, 0, 90, ["PASS"]), (12, "a", 20, 21, -1, 90, 20, [])], "cid long, ctg string, pos long, end long, CNDIFF int, REFSTART long, REFSTOP long, filter array<string>")
    got = {r.cid: (r.CN, r.filter, r.SOURCE, r.DEDUP) for r in gvcf.combine_cnv(cnv, conv).collect()}
    assert got == {1: (1, ["SVdup"], "CNV", "a:20-90"), 3: (1, [], "CNV", None), 4: (3, ["PASS"], "CNV", None), 6: (0, [], "CNV", None), 10: (1, [], "SV_CNV", None), 11: (2, ["PASS"], "SV_CNV", None), 12: (1, [], "SV_CNV", None)}
    w = spark.createDataFrame([("ACC", ["AC", "T"], "0/1"), ("A", ["C"], "0/0")], "ref string, alt array<string>, GT string")
    assert [tuple(r) for r in gvcf.finalise(w).collect()] == [("AC", ["A"], "0/1")]


def normal(ref, pos, r, a):
    """Left alignment one base at a time."""
    while len(r) > 1 and len(a) > 1 and r[-1] == a[-1]:
        r, a = r[:-1], a[:-1]
    while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
        pos, r, a = pos + 1, r[1:], a[1:]
    while pos > 0 and min(len(r), len(a)) == 1 and len(r) != len(a) and r[0] == a[0] and r[-1] == a[-1]:
        pos, r, a = pos - 1, ref[pos - 1] + r[:-1], ref[pos - 1] + a[:-1]
    return pos, r, a


def test_left_align(spark):
    rng = random.Random(9)
    ref = "ACACACACAC" + "T" * 200 + "".join(rng.choices("AC", k=300)) + "GAT" * 60
    chunks = spark.createDataFrame([("a", k, ref[k * 64 : k * 64 + 64]) for k in range(-(-len(ref) // 64))], "ctg string, chunk long, seq string")
    cases = []
    for _ in range(150):
        p, n = rng.randrange(1, len(ref) - 12), rng.randint(1, 6)
        if rng.random() < 0.5:
            cases.append((p, ref[p : p + n + 1], ref[p]))
        else:
            unit = ref[p + 1 : p + 1 + n] if rng.random() < 0.7 else "".join(rng.choices("ACGT", k=n))
            cases.append((p, ref[p] + ref[p + 1], ref[p] + unit + ref[p + 1]))
    cases += [(5, ref[5], "G" if ref[5] != "G" else "A"), (209, ref[209:211], "T")]
    rows = [(k, "a", p, p + len(r), r, [a]) for k, (p, r, a) in enumerate(cases)] + [(900, "a", 9, 11, ref[9:11], ["C", "CTT"]), (901, "a", 9, 10, "C", ["<DEL>"])]
    got = {r.vid: (r.pos, r.ref, r.alt, r.end) for r in left_align(spark.createDataFrame(rows, "vid long, ctg string, pos long, end long, ref string, alt array<string>"), chunks, chunk=64, window=8).collect()}
    for k, (p, r, a) in enumerate(cases):
        pos, r, a = normal(ref, p, r, a)
        assert got[k] == (pos, r, [a], pos + len(r)), (cases[k], got[k])
    assert got[900] == (9, ref[9:11], ["C", "CTT"], 11) and got[901] == (9, "C", ["<DEL>"], 10)


def test_alts_move_together_and_finalise_aligns(spark):
    ref = "GGCT" + "CA" * 20 + "TTG"
    chunks = spark.createDataFrame([("a", k, ref[k * 16 : k * 16 + 16]) for k in range(-(-len(ref) // 16))], "ctg string, chunk long, seq string")
    rows = [
        (1, "a", 39, 42, ref[39:42], [ref[39], ref[39:42] + ref[40:42]], "1/2"),  # a unit less, a unit more: both move to the begin of the array
        (2, "a", 39, 42, ref[39:42], [ref[39], ref[39:42] + "G"], "1/2"),  # the second has nothing to move over
        (3, "a", 41, 42, ref[41], ["AC" + ref[41], "ACAC" + ref[41]], "1/2"),  # the shared base stands last
        (4, "a", 39, 42, ref[39:42], [ref[39], ref[39:42] + ref[40:42], ref[39:41]], "1/1"),  # ALTs that no genotype has go first
    ]
    v = spark.createDataFrame(rows, "vid long, ctg string, pos long, end long, ref string, alt array<string>, GT string")
    got = {r.vid: (r.pos, r.ref, r.alt, r.end) for r in left_align(v, chunks, chunk=16, window=4).collect()}
    assert got[1] == (3, "TCA", ["T", "TCACA"], 6) and got[3] == (3, "T", ["TCA", "TCACA"], 4)
    assert got[2] == (39, ref[39:42], [ref[39], ref[39:42] + "G"], 42)
    v = v.where("vid = 4").withColumns({"PL": F.lit(None).cast("array<int>"), "AD": F.lit(None).cast("array<int>")})
    done = gvcf.finalise(v, chunks=chunks, chunk=16).collect()
    assert [(r.pos, r.ref, r.alt, r.end) for r in done] == [(3, "TCA", ["T"], 6)]

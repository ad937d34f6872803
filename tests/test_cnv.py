import random

from pyspark.sql import functions as F

from strandframe.operators import joins
from strandframe.plans import cnv

SCHEMA = "cid long, ctg string, pos long, end long, start long, stop long, svtype string, cndiff int, period int, svlen int, gt string"


def test_merge_output(spark):
    rows = [
        (1, "a", 10, 0, 1000, "DEL", -1, 500, 500, "0|1"), (2, "a", 20, 20, 1000, "DEL", -1, 500, 500, "1|0"),
        (3, "b", 10, 0, 1000, "DEL", -1, 500, 500, "0|1"), (4, "b", 20, 0, 990, "DUP", 1, 500, 500, "1|0"),
        (5, "c", 10, 0, 1000, "DUP", 1, 500, 500, "0|1"), (6, "c", 20, 10, 1000, "DUP", 1, 1000, 1000, "0|1"),
        (7, "d", 10, 0, 1000, "DUP", 1, 500, 500, "0|1"), (8, "d", 20, 900, 2000, "DUP", 1, 500, 500, "0|1"),
        (9, "e", 10, 0, 1000, "DUP", 1, 500, 500, "0|1"), (10, "e", 20, 0, 1000, "DUP", 1, 700, 700, "0|1"),
        (11, "f", 10, 50, 50, "DUP", 1, 700, 700, "0|1"), (12, "g", 10, 0, 1000, "DEL", -2, 1, 1, "1|1"), (13, "g", 11, 100, 500, "DEL", -1, 1, 1, "0|1"),
        (14, "h", 10, 0, 1000, "DUP", 1, 500, 500, "0/1"), (15, "h", 12, 0, 1000, "DUP", 1, 500, 500, "0/1"),
        (16, "i", 10, 0, 1000, "DEL", -1, 500, 500, "."), (17, "i", 12, 0, 1000, "DEL", -1, 500, 500, "0/1"),
    ]
    frame = spark.createDataFrame([(*r[:3], r[2] + 1, *r[3:]) for r in rows], SCHEMA)
    found = {r.cid: r for r in cnv.merge_output(frame).collect()}
    got = {k: (r.cndiff, r.period, r.gt) for k, r in found.items()}
    assert got == {1: (-2, 500, "1|1"), 5: (3, 500, "0|1"), 7: (1, 500, "0|1"), 8: (1, 500, "0|1"), 9: (1, 500, "0|1"), 10: (1, 700, "0|1"), 11: (1, 700, "0|1"), 12: (-2, 1, "1|1"), 14: (1, 500, "0|1"), 16: (-2, 500, "0/.")}
    assert (found[14].svlen, found[14].pos, found[14].end) == (1000, 0, 1000) and (found[5].svlen, found[5].pos) == (500, 10)
    assert cnv.merge_output(frame.limit(0)).collect() == []


def test_merge_output_equals_one_fold(spark):
    rng = random.Random(2)
    rows = []
    for k in range(400):
        start = rng.randint(0, 40) * 100
        pos = start + rng.randint(-300, 700)  # so that ranges and places are in different orders
        stop = start + rng.choice([0, 500, 1000, 1000, 1100])
        kind = rng.choice(["DEL", "DUP", "DUP"])
        rows.append((k, rng.choice("abc"), pos, pos + 1, start, stop, kind, rng.choice([1, 2]) * (1 if kind == "DUP" else -1), rng.choice([250, 500]), rng.choice([500, 1000]), rng.choice(["0|1", "1|0", "1/1", "./1"])))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    want = []
    for c in "abc":
        last = None
        for x in sorted((dict(zip(names, r)) for r in rows if r[1] == c), key=lambda x: (x["pos"], x["cid"])):
            merged = None if last is None else cnv.merge_pair(last, x)
            if merged is None and last is not None:
                want.append(last)
            last = None if merged == "drop" else merged or x
        want += [last] if last else []
    got = [r.asDict() for r in cnv.merge_output(spark.createDataFrame(rows, SCHEMA)).collect()]
    order = lambda x: (x["ctg"], x["pos"], x["cid"])
    assert sorted(got, key=order) == sorted(want, key=order) and len(got) < 380


def test_first_period(spark):
    rng = random.Random(1)
    unit = "".join(rng.choices("ACGT", k=300))
    other = "".join(rng.choices("ACGT", k=1000))
    rows = [(1, unit * 5), (2, other), (3, "ACGT"), (4, other[:450])]
    got = {r.id: r.period for r in cnv.first_period(spark.createDataFrame(rows, "id long, seq string")).collect()}
    assert got == {1: 300, 2: 1000, 4: 450}


def ratio(a, b):
    return 2 * joins._lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def test_periods_are_refined(spark):
    rng = random.Random(1)
    base = lambda n: "".join(rng.choices("ACGT", k=n))
    unit, half = base(400), base(430)
    rows = [("three", unit * 3), ("none", base(900)), ("short", "ACGT"), ("middle", half * 2), ("small", base(150) * 8)]
    got = {}
    for r in cnv.find_periods(spark.createDataFrame(rows, "id string, seq string")).collect():
        got.setdefault(r.id, set()).add(r.period)
    assert got["three"] == {400} and got["none"] == {900} and "short" not in got and got["middle"] == {430}
    assert got["small"] <= {450, 600} and got["small"]


def test_alleles_are_split(spark):
    rng = random.Random(2)
    base = lambda n: "".join(rng.choices("ACGT", k=n))
    long, other = base(600), base(500)
    rows = [(1, "a", 10, 11, "A", ["A" + long, "A" + other, "*"], "1|2"), (2, "a", 50, 50 + 601, "C" + long, ["C", "C" + long[:-1]], "0/1"), (3, "a", 90, 91, "A", ["A" + long], "0|1"), (4, "a", 95, 103, "ACGTACGT", [long + "ACGTACGT", "A"], "0|1")]
    got = {(r.vid, r.allele): (r.pos, r.ref, r.alt[0], r.GT, r.insertion) for r in cnv.split_alleles(spark.createDataFrame(rows, "vid long, ctg string, pos long, end long, ref string, alt array<string>, GT string")).collect()}
    assert got[1, 0] == (10, "A", "A" + long, "0/1", True) and got[1, 1][2] == "A" + other and (1, 2) not in got
    assert got[2, 0] == (50, "C" + long, "C", "0/1", False) and (2, 1) not in got and got[3, 0] == (90, "A", "A" + long, "0|1", True)
    assert got[4, 0] == (95, "A", long, "0/1", True)


def test_long_insertions_become_copy_number_calls(spark):
    rng = random.Random(3)
    base = lambda n: "".join(rng.choices("ACGT", k=n))
    unit = base(500)
    ref = base(2000) + unit * 3 + base(2000)  # an array of three units from 2000 to 3500
    place = 2500
    rows = [
        (1, "a", place - 1, place, ref[place - 1], [ref[place - 1] + unit * 2], [], "0|1"),
        (2, "b", 2999, 3500, ref[2999:3500], [ref[2999]], ["PASS"], "1|1"),
        (3, "a", 100, 101, ref[100], [ref[100] + base(600)], [], "0/1"),
        (4, "a", 120, 121, ref[120], [ref[120] + base(50)], [], "0/1"),
        (5, "a", 130, 131, ref[130], [ref[130] + unit], ["low"], "0/1"),
    ]
    v = spark.createDataFrame(rows, "vid long, ctg string, pos long, end long, ref string, alt array<string>, filter array<string>, GT string")
    chunks = spark.createDataFrame([(c, k, ref[k * 256 : k * 256 + 256]) for c in "ab" for k in range(-(-len(ref) // 256))], "ctg string, chunk long, seq string")
    got = {r.cid.split(":")[0]: r for r in cnv.indel_to_cnv(v, chunks, chunk=256).collect()}
    assert {(k, r.svtype, r.cndiff, r.gt) for k, r in got.items()} == {("1", "DUP", 2, "0|1"), ("2", "DEL", -2, "1|1")}
    for r in got.values():
        assert abs(r.period - 500) <= 1 and r.svlen == r.period and abs(r.start - 1 - 2000) <= 12 and abs(r.stop - 1 - 3500) <= 12


def test_array_is_walked_to_its_ends(spark):
    rng = random.Random(4)
    unit = "".join(rng.choices("ACGT", k=40))
    ref = "".join(rng.choices("ACGT", k=200)) + unit * 12 + "".join(rng.choices("ACGT", k=200))
    chunks = spark.createDataFrame([("a", k, ref[k * 64 : k * 64 + 64]) for k in range(-(-len(ref) // 64))], "ctg string, chunk long, seq string")
    rows = spark.createDataFrame([("x", "a", 320, 360, unit), ("y", "a", 0, 40, ref[:40])], "key string, ctg string, start long, stop long, unit string")
    for compat, edge in ((False, 0), (True, 40)):
        got = {r.key: (r.array_start, r.array_stop) for r in cnv.extend_array(rows, chunks, compat=compat, chunk=64).collect()}
        assert got == {"x": (200 - edge, 680 + edge), "y": (-edge, 40 + edge)}


def test_records_that_cannot_be_worked_on_give_no_row(spark):
    unit = "".join(random.Random(6).choices("ACGT", k=500))
    rows = [(1, "a", 10, "A", ["A" + unit * 2], [], "0/x"), (2, "a", None, "A", ["A" + unit * 2], [], "0/1"), (3, "a", 30, "A", [], [], "0/1"), (4, "a", 40, None, ["AC"], [], "0/1"), (5, "a", 60, "A", ["A" + unit], [], "0/1")]
    v = spark.createDataFrame(rows, "vid long, ctg string, pos long, ref string, alt array<string>, filter array<string>, GT string").withColumn("end", F.col("pos") + 1)
    assert sorted(map(tuple, cnv.unusable(v).collect())) == [(1, "no genotype"), (2, "no place"), (3, "no alleles"), (4, "no alleles")]
    chunks = spark.createDataFrame([("a", 0, unit)], "ctg string, chunk long, seq string")
    assert cnv.indel_to_cnv(v, chunks, chunk=1000).where("cid not like '5:%'").count() == 0


def test_oversized_deletions_in_compat_need_an_allele_with_a_period(spark, monkeypatch):
    monkeypatch.setattr(cnv, "LONGEST", 1500)
    rng = random.Random(7)
    ref = "".join(rng.choices("ACGT", k=5000))
    rows = [(1, "a", 100, 2200, ref[100:2200], [ref[100]], [], "0/1"), (2, "a", 2300, 4400, ref[2300:4400], [ref[2300], ref[2300:3600]], [], "1/2")]
    v = spark.createDataFrame(rows, "vid long, ctg string, pos long, end long, ref string, alt array<string>, filter array<string>, GT string")
    chunks = spark.createDataFrame([("a", k, ref[k * 1000 : k * 1000 + 1000]) for k in range(5)], "ctg string, chunk long, seq string")
    huge = lambda compat: {r.cid.split(":")[0] for r in cnv.indel_to_cnv(v, chunks, compat=compat, chunk=1000).collect() if r.svlen > 1500}
    assert huge(False) == {"1", "2"} and huge(True) == {"2"}

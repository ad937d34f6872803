from pyspark.sql import functions as F

from strandframe.plans import patch

SCHEMA = "ctg string, pos long, id string, ref string, alt array<string>, qual double, filter array<string>, GT string, GQ int, DP int, PS long, PL array<int>, AD array<int>, STR boolean, RU string, RPA array<int>, DELTA boolean, file_order long"


def call(pos, ref="A", alt="C", GT="1", PL=(30, 0), GQ=30, **k):
    base = dict(ctg="a", pos=pos, id=".", ref=ref, alt=alt.split(","), qual=10.0, filter=[], GT=GT, GQ=GQ, DP=7, PS=None, PL=list(PL) if PL else None, AD=None, STR=None, RU=None, RPA=None, DELTA=None, file_order=pos)
    return base | k


def table(spark, *rows):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


def by_pos(df):
    return {r.pos: r for r in df.collect()}


def test_patch_haploid(spark):
    v = table(spark, call(1), call(2), call(3), call(4, GT="0", PL=(0, 50)), call(5, STR=True, RPA=[4, 5]), call(6, filter=["low"]), call(7, alt="C,G,T", GT="3", PL=(40, 9, 5, 0)))
    d = table(spark, call(1, alt="C,G"), call(2, alt="G"), call(3, GT=None), call(8, alt="T"))
    got = by_pos(patch.patch_haploid(v, d))
    assert sorted(got) == [1, 2, 3, 5, 6, 7, 8]
    assert got[1].alt == ["C", "G"] and got[1].DELTA and got[2].alt == ["C"] and not got[2].DELTA and got[3].alt == ["C"] and got[8].DELTA
    assert got[5].DELTA and got[6].filter == [] and (got[7].alt, got[7].GT, got[7].PL) == (["T", "G"], "1", [40, 0, 5])


def test_patch_haploid_pair(spark):
    phased = table(spark, call(1, alt="C,G", GT="1|2", PL=(9, 8, 7, 6, 5, 4), RPA=[5, 6, 7], STR=True), call(2, GT="0/1", PL=(9, 0, 9)), call(3, GT="1/1", PL=(9, 8, 0)))
    none = table(spark).limit(0)
    one, two = (by_pos(x) for x in patch.patch_haploid_pair(none, table(spark, call(9)), phased=phased))
    assert sorted(one) == [1, 3] and sorted(two) == [1, 3, 9]
    assert (one[1].alt, one[1].PL, one[1].RPA, one[1].DELTA) == (["C"], [9, 7], [5, 6], None) and (two[1].alt, two[1].PL, two[1].RPA) == (["G"], [9, 4], [5, 7])
    assert two[9].DELTA and one[3].GT == "1"
    h1, h2 = table(spark, call(1, GT="0", PL=(0, 40)), call(2, STR=True, RPA=[4, 4])), table(spark, call(1, GT="0", PL=(0, 40)))
    one, two = (by_pos(x) for x in patch.patch_haploid_pair(none, none, h1, h2))
    assert sorted(one) == [2] and one[2].DELTA and two == {}


def test_patch_diploid(spark):
    v = table(spark, call(1, GT="0/1", PL=(9, 0, 9)), call(2, alt="C,G,T", GT="1/2", PL=(9, 9, 9, 9, 0, 9, 9, 9, 9, 9)), call(3, alt="C,G", PL=(1, 2)), call(4, GT="0/0", PL=(0, 9, 9)))
    d = table(spark, call(1, GT="./.", PL=None), call(5, GT="0/0", PL=(0, 30, 60)), call(6, GT="0/1", PL=(30, 0, 60)))
    got = by_pos(patch.patch_diploid(v, d))
    assert sorted(got) == [1, 2, 4, 6] and (got[2].alt, got[2].GT, got[2].PL) == (["C", "G"], "1/2", [9, 9, 9, 9, 0, 9]) and got[6].DELTA and not got[1].DELTA


def test_merge_phased(spark):
    bed = spark.createDataFrame([("a", 0, 50)], "ctg string, start long, end long")
    hap1 = table(spark, call(1, DELTA=True), call(2, DELTA=True, ref="AT", alt="A", AD=[1, 5]), call(3, DELTA=True), call(60, DELTA=True), call(4, DELTA=True, GT="0"))
    hap2 = table(spark, call(1, DELTA=True), call(2, ref="A", alt="ATT", AD=[2, 3]), call(4, GT="0"))
    unphased = table(spark, call(5, DELTA=True, GT="0/1"), call(6, DELTA=True, GT="0/0"))
    phased = table(spark, call(3, alt="T", GT="0|1", PL=(9, 0, 9), PS=77), call(7, ref="AC", alt="A", GT="0/1", PS=5), call(8, GT="0/0"), call(9, ref="AC", alt="A", GT="0/1", filter=["x"]))
    got = by_pos(patch.merge_phased(hap1, hap2, unphased, phased, bed))
    assert sorted(got) == [1, 2, 3, 5, 7, 60]
    assert (got[1].GT, got[1].alt, got[1].AC, got[1].qual, got[1].PS, got[1].DP) == ("1|1", ["C"], [2], 20.0, 1, 14)
    assert (got[2].ref, got[2].alt, got[2].GT) == ("AT", ["A", "ATTT"], "1|2")
    assert got[2].AD[1] == 5 and got[2].AD[2] == 3 and got[2].end == 4
    assert (got[3].alt, got[3].PS) == (["T"], 1) and got[5].DELTA is None and got[7].PS == 1 and got[60].GT == "0/1"
    assert got[1].PL[2] == 0 and got[1].GQ == sorted(got[1].PL)[1]


def test_regions(spark):
    v, w = table(spark, call(1), call(30)), table(spark, call(31, alt="T"), call(1, alt="C"))
    bed = spark.createDataFrame([("a", 20, 40)], "ctg string, start long, end long")
    got = patch.replace_in_regions(v, w, bed).select("pos", F.element_at("alt", 1).alias("x")).collect()
    assert sorted(map(tuple, got)) == [(1, "C"), (31, "T")]
    assert patch.haploid_and_diploid(patch.calls(v), patch.calls(w)).count() == 3


def test_fields_of_merged_calls_follow_the_header(spark):
    """INFO begins with the phased record's, fields by allele and QD go; samples keep no field of their own, and nothing tells of the old phase."""
    text = "map<string,string>"
    schema = f"ctg string, pos long, ref string, alt array<string>, filter array<string>, GT string, PL array<int>, DELTA boolean, info_dp int, info {text}, sample {text}"
    sample = {"PGT": "0|1", "PID": "1", "SB": "3"}
    hap = [("a", 5, "A", ["C"], [], "1", [30, 0], True, None, {"QD": "7"}, sample)]
    phased = [("a", 5, "A", ["C"], ["low"], "0/1", [30, 0, 9], None, None, {"MQ": "60", "QD": "2", "XA": "1", "AD": "2,3"}, sample), ("a", 9, "A", ["G"], [], "0|1", [30, 0, 9], None, 4, {"MQ": "50", "QD": "3"}, sample)]
    unphased = [("a", 12, "A", ["G", "AT"], [], "0/1", None, True, None, {"QD": "3"}, sample)]
    frame = lambda rows: spark.createDataFrame(rows, schema)
    bed = spark.createDataFrame([], "ctg string, start long, end long")
    got = {r.pos: r for r in patch.merge_phased(frame(hap), frame([]), frame(unphased), frame(phased), bed, {"XA": "A", "AD": "R", "MQ": "1"}).collect()}
    assert got[5].info == {"MQ": "60"} and got[5].sample == {} and (got[5].DP, got[5].info_dp) == (0, 0)
    assert got[9].info == {"MQ": "50", "QD": "3"} and got[9].sample == {"SB": "3"} and got[12].sample == {"SB": "3"} and got[12].DELTA is None
    default = {r.pos: r for r in patch.merge_phased(frame(hap), frame([]), frame(unphased), frame(phased), bed).collect()}
    assert default[5].info == {"MQ": "60", "XA": "1"}

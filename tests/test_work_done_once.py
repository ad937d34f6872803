"""Work that grows with the input is done once, and side by side."""

import random

import numpy as np
from pyspark.sql import functions as F

from strandframe.operators import intervals, joins
from strandframe.operators.normalise import left_align
from strandframe.plans import cnv, gvcf, patch, repeats
from strandframe.sources import text


def test_short_texts_side_by_side():
    rng = random.Random(5)
    for letters, longest in (("ACGT", 150), ("abé漢\0 x", 300), ("".join(map(chr, range(33, 400))), 80)):
        a = ["".join(rng.choices(letters, k=rng.randint(0, longest))) for _ in range(300)]
        b = [x[rng.randint(0, 9) :] + rng.choice(letters) if rng.random() < 0.7 else rng.choice(a) for x in a]
        for t in (0.0, 0.8, 0.96):
            assert np.array_equal(joins._similarities(a, b, t), [joins.similarity(x, y, t) for x, y in zip(a, b)])
    assert np.isnan(joins._similarities([None, "A"], ["A", None], 0.5)).all()


def test_find_periods_works_out_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    unit = "ACGTTGCAAGCTTAGCCATG"
    rows = spark.createDataFrame([(i, unit[i % 5 :] * (2 + i % 3)) for i in range(40)], "id long, seq string").select("id", counted("seq").alias("seq"))
    assert cnv.find_periods(rows, least=16, step=5).count() >= 40
    assert seen.value <= 80  # the input, and the test of its length


def test_patching_works_out_kept_alleles_once(spark):
    """The rules on alleles stand once in the plan, not once for each field that follows from them."""
    schema = "ctg string, pos long, ref string, alt array<string>, GT string, PL array<int>, file_order long"
    v = spark.createDataFrame([("a", 1, "A", ["C", "G", "T"], "0/1", [9, 5, 7, 0, 1, 2, 3, 4, 8, 6], 1)], schema)
    one, two = patch.patch_haploid_pair(v, v, v, v)
    for found in (patch.patch_diploid(v, v), patch.patch_haploid(v, v), one, two):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lambdafunction(") < 130  # 139 to 361 where each field works them out


def _counted(spark, rows, column):
    """``rows`` whose ``column`` (a string) goes through a function that counts its calls."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    return rows.withColumn(column, counted(column)), seen


def test_cutting_alts_reads_its_input_once(spark):
    v = spark.createDataFrame([(i, "A", ["C", "G"], [".", "0.5"] if i % 2 else ["0.1", "0.2"]) for i in range(20)], "vid long, ref string, alt array<string>, AF array<string>")
    found = gvcf.trim_added_alts(v)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1  # 2 where rows that lose an ALT are worked out apart
    assert {r.vid: r.alt for r in found.collect()} == {i: ["G"] if i % 2 else ["C", "G"] for i in range(20)}


def test_levels_of_patching_are_compiled_and_haplotypes_come_together(spark):
    """No generator holds a lambda function, which would have it interpreted with the calls that it makes; two haplotypes are one pass."""
    schema = "ctg string, pos long, ref string, alt array<string>, GT string, PL array<int>, file_order long"
    v = spark.createDataFrame([("a", 1, "A", ["C", "G", "T"], "1", [9, 5, 7, 0], 1)], schema)
    bed = spark.createDataFrame([("a", 0, 9)], "ctg string, start long, end long")
    both = patch.patch_both_haplotypes(v, v, v, v)
    for found in (both, patch.patch_diploid(v, v), patch.patch_haploid(v, v), patch.merge_phased(v, v, v, v, bed)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.splitlines() if "Generate" in x and "lambdafunction(" in x.split("Generate", 1)[1].split("], ")[0]]
    one, two = patch.patch_haploid_pair(v, v, v, v)
    rows = lambda df: [(r.ctg, r.pos, r.alt) for r in df.collect()]
    assert sorted((r.hap, r.ctg, r.pos, r.alt) for r in both.collect()) == [(1, *x) for x in rows(one)] + [(2, *x) for x in rows(two)]
    assert len(rows(one)) == len(rows(two)) == 1


def test_calls_that_meet_are_moved_once(spark):
    """One shuffle for all inputs of a position, which serves the intervals that hold it too."""
    schema = "ctg string, pos long, ref string, alt array<string>, GT string, DELTA boolean, file_order long"
    v = spark.createDataFrame([("a", 1, "A", ["C"], "1", True, 1), (None, 1, "A", ["G"], "1", True, 2)], schema)
    bed = spark.createDataFrame([("a", 0, 9)], "ctg string, start long, end long")
    moves = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    both = joins.cogroup_pos({c: v for c in "abcd"})
    merged = patch.merge_phased(v, v, v, v, bed)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert moves(both) == 1  # 10 where inputs are joined one after the other
        assert moves(merged) == 2 + moves(intervals.merge(bed))  # the calls, and the intervals to them
        assert sorted((r.ctg or "", r.pos, *(getattr(r, c) is not None for c in "abcd")) for r in both.collect()) == [("", 1, *(c == d for d in "abcd")) for c in "dcba"] + [("a", 1, True, True, True, True)]
        assert [(r.ctg, r.PS) for r in merged.collect() if r.ctg] == [("a", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_writing_calls_works_them_out_once(spark, tmp_path):
    v = spark.createDataFrame([("b" if i % 2 else "a", i, i + 1, str(i)) for i in range(40)], "ctg string, pos long, end long, id string")
    v = v.selectExpr("*", "'A' as ref", "array('C') as alt", "1.5D as qual", "cast(array() as array<string>) as filter", "map('DP', '3') as info", "array('GT') as format", "array(map('GT', '0/1')) as samples")
    v, seen = _counted(spark, v, "id")
    contigs = spark.createDataFrame([("b", 0), ("a", 1)], "ctg string, ctg_idx long")
    text.write_vcf(v, spark.createDataFrame([("##x",)], "value string"), contigs, str(tmp_path / "v"))
    assert seen.value == 40  # 80 where dealing rows to ranges reads what they are made of
    got = [(r.ctg, r.pos) for r in text.read_vcf(spark, str(tmp_path / "v/records"))[0].orderBy("file_order").collect()]
    assert got == [("b", i) for i in range(1, 40, 2)] + [("a", i) for i in range(0, 40, 2)]


def _documents_counted(spark, monkeypatch):
    """Twelve documents' bases in place of those that the registered queries read, and how often they are worked out."""
    rng = random.Random(3)
    made = spark.createDataFrame([(i, "".join(rng.choices("ACGT", k=300 if i < 11 else 50))) for i in range(12)], "doc_id long, seq string")
    made, seen = _counted(spark, made, "seq")
    monkeypatch.setattr(repeats, "_dna", lambda *_: made)
    return seen


def test_local_match_query_works_out_its_bases_once(spark, monkeypatch):
    seen = _documents_counted(spark, monkeypatch)
    assert repeats.local_match(spark, "").count() > 0
    assert seen.value == 12  # once for each round and side where calls and contigs are made of them again


def test_left_align_query_works_out_its_bases_once(spark, monkeypatch):
    seen = _documents_counted(spark, monkeypatch)
    assert repeats.left_align(spark, "").count() == 11
    assert seen.value == 12  # once for each round and for the anchors where contigs are made of them again


def test_left_align_reads_its_calls_once(spark):
    v = spark.createDataFrame([(i, "a", 9, 11, "CA", ["C"]) for i in range(20)], "vid long, ctg string, pos long, end long, ref string, alt array<string>")
    v, seen = _counted(spark, v, "ref")
    chunks = spark.createDataFrame([("a", 0, "GTGAAAAAACAT")], "ctg string, chunk long, seq string")
    assert {(r.vid, r.ref) for r in left_align(v, chunks).collect()} == {(i, "CA") for i in range(20)}
    assert seen.value == 20  # 40 where the calls are worked out again when anchors are joined

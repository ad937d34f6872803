"""Registered queries on small tables that have what the given ones have only at size."""

import random

from strandframe.operators import intervals
from strandframe.sources import text
from strandframe.plans import fields, queries, repeats  # noqa: F401

from . import oracle


def same(spark, tmp_path, name, **tables):
    """Compares a query with its SQL on some tables, each given as a frame."""
    con = oracle.duckdb.connect()
    for table, frame in tables.items():
        frame.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert oracle.difference(spark, con, str(tmp_path), queries.QUERIES[name], queries.SQL[name]) is None


def test_opposite_insertions_far_along_a_contig(spark, tmp_path):
    """The reference is made near the calls only: whole contigs of this length would be four million chunks each."""
    far = 4_000_000_000
    rows = [(far + 1000 * i + shift, part, i % 3) for i in range(300) for shift, part in ((0, i * 5), (1 + i % 10, i * 5 + 1), (25, i * 5 + 4))]
    same(spark, tmp_path, "merge_opposite_phase", lineitem=spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long"))


def events(spark, rows):
    """Events of ``(id, user, second, hours, kind)``."""
    return spark.createDataFrame([(*r, 0) for r in rows], "event_id long, user_id long, s long, value double, event_type string, n int").selectExpr("event_id", "timestampadd(SECOND, s, timestamp_ntz'2024-01-01 00:00:00') ts", "user_id", "event_type", "value")


def test_intervals_of_no_length(spark, tmp_path):
    """Clicks and views of no length, within others, at their ends and at midnight."""
    kinds, rows = ("click", "view", "error"), []
    for user in range(4):
        for k, second in enumerate((0, 10, 3600, 3610, 86_400, 86_410, 90_000, 172_800)):
            for hours in (0.0, 1.0, 24.0)[: 1 + (k + user) % 3]:
                rows += [(3 * len(rows) + i, user, second + user % 2 * i, hours, kind) for i, kind in enumerate(kinds)]
    frame = events(spark, rows)
    for name in ("overlap_pairs", "interval_overlaps", "fraction_overlap", "combine_cnv"):
        path = tmp_path / name
        path.mkdir()
        same(spark, path, name, events=frame)


def test_calls_that_share_an_id(spark, tmp_path):
    """A table repeated with other users: an id then stands for a call of each, and each stays once."""
    rows = [(i, user, 3600 * (i // 4) + i % 2, 1.0 + i % 3, "view" if i % 2 else "click") for user in range(3) for i in range(80)]
    same(spark, tmp_path, "combine_cnv", events=events(spark, rows))


def test_gaps_around_intervals_of_no_length(spark, tmp_path):
    rows = [(user, second, hours) for user in range(5) for second, hours in ((0, 0.0), (50_000, 1.0), (60_000 + user, 0.0), (80_000, 0.0), (80_000, 0.0), (9_000_000 + user, 0.0), (9_500_000, 0.1 * user))]
    same(spark, tmp_path, "interval_complement", events=events(spark, [(i, u, s, h, "click") for i, (u, s, h) in enumerate(rows)]))
    iv = spark.createDataFrame([("a", 8, 8), ("a", 10, 10), ("a", 16, 16), ("a", 17, 18), ("a", 32, 33)], "ctg string, start long, end long")
    bounds = spark.createDataFrame([("a", 0, 40)], "ctg string, start long, end long")
    for width in (1, 3, 4, 8, 16, 64):
        assert sorted((r.start, r.end) for r in intervals.gaps(iv, bounds, width).collect()) == [(0, 8), (8, 10), (10, 16), (16, 17), (18, 32), (33, 40)]


def test_fasta_in_blocks_of_any_order(spark, tmp_path):
    """Files of several blocks, which Spark deals to tasks by size, with records over many blocks and many in one."""
    rng = random.Random(8)
    want = {}
    for k in range(4):
        lines = []
        for i, n in enumerate((5, 3000, 0, 61, 7000 + 500 * k, 1)):
            want[f"c{k}.{i}"] = seq = "".join(rng.choices("ACGT", k=n))
            lines += [f">c{k}.{i} text", *(seq[at : at + 60] for at in range(0, n, 60))]
        (tmp_path / f"f{k}.fa").write_text("\n".join(lines) + "\n")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = {}
        for r in sorted(text.read_fasta(spark, str(tmp_path), chunk=256).collect(), key=lambda r: r.chunk):
            got[r.ctg] = got.get(r.ctg, "") + r.seq
    finally:
        for c, x in old.items():
            spark.conf.set(c, x)
    assert got == {k: x for k, x in want.items() if x}

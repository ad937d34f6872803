"""Registered queries for fields, text formats, read groups and the smaller composed operators, with SQL for the same rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alleles as A
from ..operators import aggregates, filters, intervals, joins, sequence
from ..sources import text
from . import gvcf, patch
from .queries import _CALLS, _DNA, _FIRST, _IV, _JOINED, _MERGED, DAY, _calls, _dna, _iv, _plain, _table, query


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names in ``spark.checkpoint.dir``; without it a temporary one, in local sessions only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _list(*x) -> object:
    return F.array(*map(F.lit, x))


_ROWS = "SELECT l_orderkey, l_linenumber, l_partkey AS k, l_suppkey AS z, CAST(l_quantity AS INTEGER) AS q FROM lineitem"


def _rows(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("k"), F.col("l_suppkey").alias("z"), F.col("l_quantity").cast("int").alias("q"))


@query(f"""WITH r AS ({_ROWS}), a AS (SELECT *, left('ACCG', CAST(k % 4 + 1 AS INTEGER)) AS r1, left('ACCG', CAST(z % 4 + 1 AS INTEGER)) AS r2, ['0/1', '1|2', './.', '1', '0|.'][k % 5 + 1] AS gt, ['0|1', '1|0', '0|2', '1/.', '1|1'][k % 5 + 1] AS ga, ['0|1', '0/0', '0/.', '1|1'][z % 4 + 1] AS gb FROM r),
b AS (SELECT *, [CAST(x AS INTEGER) FOR x IN string_split(replace(gt, '|', '/'), '/') IF x <> '.'] AS al, [CAST(x AS INTEGER) FOR x IN string_split(replace(ga, '|', '/'), '/') IF x <> '.'] AS la, [CAST(x AS INTEGER) FOR x IN string_split(replace(gb, '|', '/'), '/') IF x <> '.'] AS lb FROM a)
SELECT l_orderkey, l_linenumber, k, CASE WHEN length(r1) < length(r2) THEN r2 ELSE r1 END AS ref, CASE WHEN length(r1) < length(r2) THEN 'G' || substr(r2, length(r1) + 1) || ',TT' WHEN length(r1) > length(r2) THEN 'G,TT' || substr(r1, length(r2) + 1) ELSE 'G,TT' END AS alts,
 array_to_string(al, ',') AS alleles, len(string_split(replace(gt, '|', '/'), '/')) AS ploidy, coalesce(list_sum(al), 0)::BIGINT AS total, CASE WHEN len(string_split(replace(gt, '|', '/'), '/')) = 1 THEN '0' ELSE '0/0' END AS homref,
 CASE WHEN len(la) > 1 AND len(lb) > 1 THEN (la[1] | lb[1]) || '|' || (la[2] | lb[2]) ELSE (coalesce(la[1], 0) | coalesce(lb[1], 0)) || '/.' END AS either, l_orderkey + 1 + (k % 3 + 1) * (z % 6) AS repeat_end, greatest(l_orderkey - k, k - l_orderkey - 50, 0) AS distance, CAST(q % 5 - 2 + 2 AS INTEGER) AS copies FROM b""")
def genotype_fields(spark, sf_dir):
    k, z = F.col("k"), F.col("z")
    pick = lambda names, i: F.get(_list(*names), i.cast("int"))
    r = _rows(spark, sf_dir).withColumns({"r1": F.substring(F.lit("ACCG"), F.lit(1), (k % 4 + 1).cast("int")), "r2": F.substring(F.lit("ACCG"), F.lit(1), (z % 4 + 1).cast("int")), "gt": pick(("0/1", "1|2", "./.", "1", "0|."), k % 5), "ga": pick(("0|1", "1|0", "0|2", "1/.", "1|1"), k % 5), "gb": pick(("0|1", "0/0", "0/.", "1|1"), z % 4)})
    both = A.combine_alleles("r1", F.lit("G"), "r2", F.lit("TT"))
    unit = F.repeat(F.lit("A"), (k % 3 + 1).cast("int"))
    return r.select(
        "l_orderkey", "l_linenumber", "k", both["ref"].alias("ref"), F.array_join(both["alts"], ",").alias("alts"), F.array_join(A.gt_alleles("gt"), ",").alias("alleles"), A.ploidy_of_gt("gt").alias("ploidy"), A.allele_count("gt").cast("long").alias("total"), A.homref_gt(A.ploidy_of_gt("gt")).alias("homref"),
        A.gt_or("ga", "gb").alias("either"), A.str_end("l_orderkey", unit, F.array(z % 6)).alias("repeat_end"), A.edge_distance("k", F.col("l_orderkey"), F.col("l_orderkey") + 50).alias("distance"), A.copy_number(F.col("q") % 5 - 2).alias("copies"),
    )


@query(f"""WITH r AS ({_ROWS}), a AS (SELECT *, CASE WHEN k % 3 > 0 THEN [q, k % 7, k % 5] END AS a1, CASE WHEN z % 3 > 0 THEN [z % 9, k % 4, q % 6] END AS a2, [k % 4, q % 3, z % 3] AS p1, [z % 4, k % 3, q % 2] AS p2, [k % 40, q % 20, z % 30] AS pl FROM r)
SELECT l_orderkey, l_linenumber, k, array_to_string(CASE WHEN a1 IS NOT NULL AND a2 IS NOT NULL THEN [a1[i] + a2[i] FOR i IN [1, 2, 3]] WHEN a1 IS NOT NULL THEN [greatest(a1[1], 60 - a1[2] - a1[3]), a1[2], a1[3]] WHEN a2 IS NOT NULL THEN [greatest(a2[1], 60 - a2[2] - a2[3]), a2[2], a2[3]] END, ',') AS depths,
 CASE WHEN list_min([greatest(p1[i], p2[i]) FOR i IN [1, 2, 3]]) > 0 THEN array_to_string([greatest(p1[i], p2[i]) FOR i IN [1, 2, 3]], ',') END AS repeats, coalesce(CASE WHEN k % 4 > 0 THEN 'AC' END, CASE WHEN z % 4 > 0 THEN 'GT' END) AS unit,
 coalesce(CASE WHEN k % 5 = 0 THEN k % 11 END, CASE WHEN k % 3 > 0 OR z % 3 > 0 THEN coalesce(CASE WHEN k % 3 > 0 THEN k % 8 END, 0) + coalesce(CASE WHEN z % 3 > 0 THEN z % 8 END, 0) END) AS depth, round((k % 10) * (z % 10) / 100.0, 2) AS prob,
 CASE WHEN k % 5 = 4 THEN -1 ELSE k % 3 END AS allele, CASE WHEN k % 5 = 4 THEN 999999999 ELSE pl[k % 3 + 1] END AS pl, list_sort(pl)[2] AS second, list_position(pl, list_min(pl)) - 1 AS best FROM a""")
def joined_fields(spark, sf_dir):
    k, z, q = F.col("k"), F.col("z"), F.col("q").cast("long")
    longs = lambda *x: F.array(*[v.cast("long") for v in x])
    a1, a2 = F.when(k % 3 > 0, longs(q, k % 7, k % 5)), F.when(z % 3 > 0, longs(z % 9, k % 4, q % 6))
    pl, index = longs(k % 40, q % 20, z % 30), F.when(k % 5 == 4, F.lit(-1)).otherwise((k % 3).cast("int"))
    best = A.best_pl(pl, index)
    r = _rows(spark, sf_dir)
    return r.select(
        "l_orderkey", "l_linenumber", "k", F.array_join(A.join_ad(a1, a2, F.lit(60)), ",").alias("depths"), F.array_join(A.join_rpa(longs(k % 4, q % 3, z % 3), longs(z % 4, k % 3, q % 2)), ",").alias("repeats"), A.join_str_ru(F.when(k % 4 > 0, "AC"), F.when(z % 4 > 0, "GT")).alias("unit"),
        A.join_dp(F.when(k % 5 == 0, k % 11), F.when(k % 3 > 0, k % 8), F.when(z % 3 > 0, z % 8)).alias("depth"), A.join_ml_prob((k % 10) / 10, (z % 10) / 10).alias("prob"), best["allele"].alias("allele"), best["pl"].alias("pl"), A.second_smallest(pl).alias("second"), A.best_genotype(pl).alias("best"),
    )


@query(f"""WITH r AS ({_ROWS}), a AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'AC' ELSE 'A' END AS r, CASE WHEN k % 2 = 0 THEN [['GC', 'AT'], ['TC', 'A']][z % 2 + 1] ELSE [['G', 'T'], ['T', 'C']][z % 2 + 1] END AS al, CASE WHEN z % 3 = 0 THEN 'AC' ELSE 'A' END AS r0, CASE WHEN z % 3 = 0 THEN ['AT', 'GC', 'TC'] ELSE ['G', 'T'] END AS a0 FROM r),
t AS (SELECT *, [CASE WHEN r = 'AC' AND right(x, 1) = 'C' AND length(x) > 1 THEN 'A>' || left(x, length(x) - 1) ELSE r || '>' || x END FOR x IN al] AS one, [CASE WHEN r0 = 'AC' AND right(x, 1) = 'C' AND length(x) > 1 THEN 'A>' || left(x, length(x) - 1) ELSE r0 || '>' || x END FOR x IN a0] AS two FROM a)
SELECT l_orderkey, l_linenumber, k, '0,' || array_to_string([coalesce(nullif(list_position(two, x), 0), -1) FOR x IN one], ',') AS places, list_has_all(two, one) AS whole FROM t""")
def allele_matches(spark, sf_dir):
    k, z = F.col("k"), F.col("z")
    r = _rows(spark, sf_dir).withColumns({"r": F.when(k % 2 == 0, "AC").otherwise("A"), "al": F.when((k % 2 == 0) & (z % 2 == 0), _list("GC", "AT")).when(k % 2 == 0, _list("TC", "A")).when(z % 2 == 0, _list("G", "T")).otherwise(_list("T", "C")), "r0": F.when(z % 3 == 0, "AC").otherwise("A"), "a0": F.when(z % 3 == 0, _list("AT", "GC", "TC")).otherwise(_list("G", "T"))})
    return r.select("l_orderkey", "l_linenumber", "k", F.array_join(A.allele_map("r", "al", "r0", "a0"), ",").alias("places"), A.match_alleles("r", "al", "r0", "a0").alias("whole"))


@query(f"""WITH r AS ({_ROWS}) SELECT l_orderkey, l_linenumber, k, 'X' || k % 7 AS id, ['A', 'R', '1'][z % 3 + 1] AS number, 'a, b ' || k AS about, '0.' || q AS af, CASE WHEN z % 2 = 0 THEN 'AC' END AS unit, z % 4 > 0 AS repeat, CAST(k AS VARCHAR) AS rg, 's:' || q AS sample FROM r""")
def header_fields(spark, sf_dir):
    k, z, q = F.col("k"), F.col("z"), F.col("q")
    line = F.concat(F.lit("##INFO=<ID=X"), k % 7, F.lit(",Number="), F.get(_list("A", "R", "1"), (z % 3).cast("int")), F.lit(',Type=Integer,Description="a, b '), k, F.lit('">'))
    info = F.concat_ws(";", F.concat(F.lit("AF=0."), q), F.when(z % 4 > 0, "STR"), F.when(z % 2 == 0, "RU=AC"))
    group = F.concat(F.lit("@RG\tID:"), k, F.lit("\tSM:s:"), q)
    rows = _rows(spark, sf_dir).select("l_orderkey", "l_linenumber", "k", A.parse_header(line).alias("h"), A.parse_info(info).alias("i"), A.parse_rg(group).alias("g"))
    return rows.select("l_orderkey", "l_linenumber", "k", F.col("h")["ID"].alias("id"), F.col("h")["Number"].alias("number"), F.col("h")["Description"].alias("about"), F.col("i")["AF"].alias("af"), F.col("i")["RU"].alias("unit"), F.map_contains_key("i", "STR").alias("repeat"), F.col("g")["ID"].alias("rg"), F.col("g")["SM"].alias("sample"))


@query("""WITH g AS (SELECT CAST(s_suppkey AS VARCHAR) AS rg FROM supplier), r AS (SELECT CAST(l_suppkey AS VARCHAR) AS rg, l_partkey % 4096 AS flag, l_partkey % 3 AS hp FROM lineitem)
SELECT r.rg || '-x' AS rg, CASE WHEN g.rg IS NOT NULL THEN g.rg || '-x' END AS id, CASE WHEN g.rg IS NOT NULL THEN 'me' END AS sm, CASE WHEN g.rg IS NOT NULL THEN '1' END AS lr, count(*) AS n, count(*) FILTER (flag & 3840 = 0) AS plain, count(*) FILTER (hp = 1) AS first, count(*) FILTER (hp > 0) AS phased FROM r LEFT JOIN g ON r.rg = g.rg GROUP BY 1, 2, 3, 4""")
def relabelled_reads(spark, sf_dir):
    groups = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("rg")).withColumn("tags", F.create_map(F.lit("ID"), F.col("rg"), F.lit("SM"), F.lit("old"), F.lit("LR"), F.lit("0")))
    k = F.col("l_partkey")
    reads = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("rg"), (k % 4096).alias("flag"), F.when(k % 3 > 0, (k % 3).cast("int")).alias("HP"))
    named = filters.relabel_sample(reads, groups, "me", long_reads=True, suffix="-x").select("rg", "flag", "HP", F.col("tags")["ID"].alias("id"), F.col("tags")["SM"].alias("sm"), F.col("tags")["LR"].alias("lr"))
    parts = {"n": named, "plain": filters.flag_filter(named, 0xF00, 0), "first": filters.select_phase(named, 1), "phased": filters.select_phase(named)}
    counts = None
    for name, df in parts.items():
        one = df.groupBy("rg", "id", "sm", "lr").agg(F.count("*").alias(name))
        counts = one if counts is None else counts.join(one.select("rg", name), "rg", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return counts


@query("""SELECT s_nationkey AS nation, count(DISTINCT CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 2 END) AS samples, count(*) FILTER (s_suppkey % 4 = 0) AS missing, count(DISTINCT CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 2 END) = 1 AND count(*) FILTER (s_suppkey % 4 = 0) = 0 AS valid, count(*) FILTER (s_suppkey % 4 = 0) = 0 AS named FROM supplier WHERE s_nationkey < 4 GROUP BY 1""")
def read_group_check(spark, sf_dir):
    k = F.col("s_suppkey")
    groups = _table(spark, sf_dir, "supplier").select("s_nationkey", k.cast("string").alias("rg"), F.when(k % 4 > 0, F.create_map(F.lit("SM"), (k % 2).cast("string"))).otherwise(F.create_map(F.lit("ID"), F.lit("x"))).alias("tags"))
    found = None
    for nation in range(4):
        own = groups.where(F.col("s_nationkey") == nation)
        both = joins.validate_one_sample(own).crossJoin(joins.validate_one_sample(own, sample="me").select(F.col("valid").alias("named"))).crossJoin(own.agg(F.count("*").alias("rows"))).where("rows > 0")
        row = both.select(F.lit(nation).cast("long").alias("nation"), "samples", "missing", "valid", "named")
        found = row if found is None else found.unionByName(row)
    return found


@query(f"""WITH iv AS ({_IV}) SELECT cid, ctg, "start" AS pos, "end" FROM iv WHERE ctg = 3 AND "end" > 1704499999 AND "start" < 1705500000""")
def region_view(spark, sf_dir):
    rows = _iv(spark, sf_dir).select("cid", F.col("ctg").cast("string").alias("ctg"), F.col("start").alias("pos"), "end")
    return intervals.region_view(rows, "3:1,704,500,000-1705500000").withColumn("ctg", F.col("ctg").cast("long"))


@query(f"""WITH iv AS ({_IV}), src AS (SELECT ctg, "start", "end" FROM iv WHERE kind IN ('click', 'view')), {_MERGED.format(d=60)} SELECT ctg, "start", "end" FROM merged""")
def interval_union(spark, sf_dir):
    iv = _iv(spark, sf_dir)
    return intervals.cat_sort_merge([iv.where("kind = 'click'"), iv.where("kind = 'view'")], d=60)


@query(f"""WITH iv AS ({_IV}) SELECT q.cid, b.cid AS cid_b FROM (SELECT *, CASE WHEN cid % 3 = 0 THEN "start" ELSE "end" END AS e FROM iv WHERE kind = 'click') q JOIN iv b ON b.kind = 'view' AND q.ctg = b.ctg AND ((b."start" <= q."start" AND q."start" < b."end") OR (b."start" > q."start" AND b."start" < q.e))""")
def interval_overlaps(spark, sf_dir):
    iv = _iv(spark, sf_dir)
    queries = iv.where("kind = 'click'").withColumn("end", F.when(F.col("cid") % 3 == 0, F.col("start")).otherwise(F.col("end")))
    return intervals.overlaps(iv.where("kind = 'view'"), queries, width=DAY).select("cid", "cid_b")


@query(f"""WITH d AS ({_DNA}), c AS (SELECT doc_id AS ctg, i AS tile, substr(seq, i * 100 + 1, 100) AS s FROM (SELECT doc_id, seq, unnest(range(0, (length(seq) + 99) // 100)) AS i FROM d)),
w AS (SELECT ctg, tile, CAST(round(100.0 * length(regexp_replace(s, '[^GC]', '', 'g')) / length(s)) AS INTEGER) AS gc FROM c), r AS (SELECT l_partkey % 50 AS ctg, l_orderkey % 2000 // 100 AS tile, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT gc, count(*) AS windows, CAST(sum(coalesce(n, 0)) AS BIGINT) AS reads FROM w LEFT JOIN r ON w.ctg = r.ctg AND w.tile = r.tile GROUP BY gc""")
def gc_bias(spark, sf_dir):
    dna = _dna(spark, sf_dir).select(F.col("doc_id").alias("ctg"), "seq", F.explode(A.upto(F.ceil(F.length("seq") / 100))).alias("chunk"))
    chunks = dna.select("ctg", F.col("chunk").cast("long").alias("chunk"), F.substring(F.col("seq"), F.col("chunk") * 100 + 1, F.lit(100)).alias("seq"))
    reads = _table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 50).alias("ctg"), (F.col("l_orderkey") % 2000).alias("start"))
    return aggregates.gc_bias(reads, aggregates.gc_windows(chunks), 100)


@query(f"""WITH iv AS ({_IV}), b AS (SELECT min("start") // 86400 * 86400 AS low FROM iv), m AS (SELECT ctg, "start" - low AS s, "end" - low AS e, cid % 4096 AS flag FROM iv, b), l AS (SELECT ctg, max(e) AS length FROM m GROUP BY ctg),
x AS (SELECT ctg, s AS p, 1 AS delta FROM m WHERE s < e AND flag & 3844 = 0 AND flag & 1 = 1 UNION ALL SELECT ctg, e, -1 FROM m WHERE s < e AND flag & 3844 = 0 AND flag & 1 = 1 UNION ALL SELECT ctg, 0, 0 FROM l UNION ALL SELECT ctg, length, 0 FROM l),
g AS (SELECT ctg, p, sum(delta) AS delta FROM x GROUP BY ctg, p), r AS (SELECT sum(delta) OVER w AS depth, lead(p) OVER w - p AS bases FROM g WINDOW w AS (PARTITION BY ctg ORDER BY p))
SELECT CAST(depth AS BIGINT) AS depth, CAST(sum(bases) AS BIGINT) AS bases FROM r WHERE bases > 0 GROUP BY depth""")
def wgs_metrics(spark, sf_dir):
    iv = _iv(spark, sf_dir)
    low = iv.agg((F.floor(F.min("start") / DAY) * DAY).alias("low"))
    moved = iv.crossJoin(F.broadcast(low)).select("ctg", (F.col("start") - F.col("low")).alias("start"), (F.col("end") - F.col("low")).alias("end"), (F.col("cid") % 4096).alias("flag"))
    return aggregates.wgs_metrics(moved, moved.groupBy("ctg").agg(F.max("end").alias("length")), step=DAY)


@query("""WITH m AS (SELECT l_suppkey AS ctg, l_orderkey AS pos, substr('ACGTACGT', CAST(l_partkey % 6 + 1 AS INTEGER), 3) AS context, substr('ACGTACGT', CAST(l_partkey % 6 + 2 AS INTEGER), 1) AS ref, ['A', 'C', 'G', 'T'][l_linenumber % 4 + 1] AS alt FROM lineitem)
SELECT context, ref, alt, count(*) AS n FROM m WHERE ref <> alt AND NOT EXISTS (SELECT 1 FROM lineitem k WHERE k.l_returnflag = 'R' AND k.l_suppkey = ctg AND k.l_orderkey = pos) GROUP BY context, ref, alt""")
def artifact_metrics(spark, sf_dir):
    k = F.col("l_partkey")
    items = _table(spark, sf_dir, "lineitem")
    rows = items.select(F.col("l_suppkey").alias("ctg"), F.col("l_orderkey").alias("pos"), F.substring(F.lit("ACGTACGT"), (k % 6 + 1).cast("int"), F.lit(3)).alias("context"), F.substring(F.lit("ACGTACGT"), (k % 6 + 2).cast("int"), F.lit(1)).alias("ref"), F.get(_list("A", "C", "G", "T"), (F.col("l_linenumber") % 4).cast("int")).alias("alt"))
    known = items.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("ctg"), F.col("l_orderkey").alias("pos"))
    return aggregates.artifact_metrics(rows.where("ref <> alt"), known)


@query("""SELECT l_returnflag AS status, count(*) AS count FROM lineitem GROUP BY 1 UNION ALL SELECT 'mean length', CAST(round(avg(l_linenumber) * 1000) AS BIGINT) FROM lineitem""")
def call_statistics(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("status"), F.repeat(F.lit("A"), F.col("l_linenumber").cast("int")).alias("seq"))
    mean = aggregates.mean_read_length(rows, n=1 << 30).select(F.lit("mean length").alias("status"), F.round(F.col("read_length") * 1000).cast("long").alias("count"))
    return aggregates.combine_stats(rows).unionByName(mean)


@query("""WITH c AS (SELECT l_orderkey AS vid, l_partkey % 200 / 200.0 AS ratio, CAST(l_quantity AS BIGINT) AS matched, l_partkey * 8 + l_linenumber AS rank FROM lineitem),
n AS (SELECT *, max(ratio) OVER (PARTITION BY vid) AS top FROM c) SELECT vid, ratio, matched, rank FROM (SELECT DISTINCT *, row_number() OVER (PARTITION BY vid ORDER BY matched DESC, rank) AS r FROM n WHERE ratio = top OR top - ratio < 0.01) WHERE r = 1""")
def best_period(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("vid"), (F.col("l_partkey") % 200 / 200).alias("ratio"), F.col("l_quantity").cast("long").alias("matched"), (F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("rank"))
    return sequence.best_period(rows)


@query("""WITH a AS (SELECT 'INFO' AS kind, p_name AS id, min(p_partkey) AS line FROM part WHERE p_partkey % 2 = 0 GROUP BY 2), b AS (SELECT 'INFO' AS kind, p_name AS id, min(p_partkey) AS line FROM part WHERE p_partkey % 3 = 0 GROUP BY 2), u AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE id NOT IN (SELECT id FROM a))
SELECT kind, id, line, 'a' AS "SOURCE" FROM u WHERE id NOT LIKE 'red%' UNION ALL SELECT kind, id, line, 'b' FROM b""")
def header_lines(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    own = lambda m: part.where(F.col("p_partkey") % m == 0).groupBy(F.col("p_name").alias("id")).agg(F.min("p_partkey").alias("line")).select(F.lit("INFO").alias("kind"), "id", "line")
    a, b = own(2), own(3)
    gone = part.where(F.col("p_name").startswith("red")).select(F.lit("INFO").alias("kind"), F.col("p_name").alias("id")).distinct()
    return joins.source_union({"a": joins.header_union(a, b, remove=gone), "b": b})


@query("""WITH e AS (SELECT l_suppkey AS ctg, max(l_orderkey) AS length FROM lineitem GROUP BY 1), f AS (SELECT l_suppkey AS ctg, max(l_orderkey) AS length FROM lineitem WHERE l_linenumber < 6 GROUP BY 1) SELECT e.ctg, e.length FROM e LEFT JOIN f ON e.ctg = f.ctg AND e.length = f.length WHERE f.ctg IS NULL""")
def contig_check(spark, sf_dir):
    lengths = lambda df: df.groupBy(F.col("l_suppkey").alias("ctg")).agg(F.max("l_orderkey").alias("length"))
    items = _table(spark, sf_dir, "lineitem")
    return joins.check_contigs(lengths(items), lengths(items.where("l_linenumber < 6")))


_HYBRID = """WITH a AS (SELECT CAST(l_suppkey % 20 AS VARCHAR) AS ctg, l_orderkey AS pos, [CAST(l_quantity AS BIGINT) % 17 * 3, l_partkey % 60, l_suppkey % 90] AS p0, [l_orderkey % 50, l_partkey % 40, CAST(l_quantity AS BIGINT) % 30] AS s0, [l_partkey % 7, l_suppkey % 5] AS lad, l_linenumber % 3 = 0 AS str FROM lineitem),
z AS (SELECT *, list_transform(p0, lambda x: x - list_min(p0)) AS lpl, list_transform(s0, lambda x: x - list_min(s0)) AS spl FROM a), y AS (SELECT *, list_position(lpl, 0) AS lg, list_position(spl, 0) AS sg, CASE WHEN NOT str AND list_position(lpl, 0) > 1 THEN lpl[1] ELSE list_sort(lpl)[2] END AS lc, list_sort(spl)[2] AS sc FROM z),
f AS (SELECT ctg, pos FROM y WHERE list_sum(lad) >= 2 AND lc >= 30 AND NOT (sc >= 30 AND (lg = sg OR (lg = 1 AND str)))), l AS (SELECT CAST(l_suppkey % 20 AS VARCHAR) AS ctg, max(l_orderkey) + 100 AS length FROM lineitem GROUP BY 1)"""


def _hybrid(spark, sf_dir):
    q = F.col("l_quantity").cast("long")
    items = _table(spark, sf_dir, "lineitem").withColumn("ctg", (F.col("l_suppkey") % 20).cast("string"))
    rows = items.select("ctg", F.col("l_orderkey").alias("pos"), (F.col("l_orderkey") + 1).alias("end"), F.array(q % 17 * 3, F.col("l_partkey") % 60, F.col("l_suppkey") % 90).alias("p0"), F.array(F.col("l_orderkey") % 50, F.col("l_partkey") % 40, q % 30).alias("s0"), F.array(F.col("l_partkey") % 7, F.col("l_suppkey") % 5).alias("LAD"), (F.col("l_linenumber") % 3 == 0).alias("STR"))
    zero = lambda c: F.transform(c, lambda x: x - F.array_min(c))
    return rows.withColumns({"LPL": zero(F.col("p0")), "SPL": zero(F.col("s0"))}), items.groupBy("ctg").agg((F.max("l_orderkey") + 100).alias("length"))


@query(f"""{_HYBRID}, w AS (SELECT f.ctg, greatest(pos - 50, 0) AS "start", least(pos + 51, length) AS "end" FROM f JOIN l ON f.ctg = l.ctg UNION ALL SELECT x.ctg, greatest(x.pos - 50, 0), least(x.pos + 51, length) FROM (SELECT DISTINCT CAST(l_suppkey % 20 AS VARCHAR) AS ctg, l_orderkey AS pos FROM lineitem WHERE l_partkey % 13 = 0) x JOIN l ON x.ctg = l.ctg), src AS (SELECT * FROM w), {_MERGED.format(d=0)} SELECT ctg, "start", "end" FROM merged""")
def difference_regions(spark, sf_dir):
    v, contigs = _hybrid(spark, sf_dir)
    low = _table(spark, sf_dir, "lineitem").where("l_partkey % 13 = 0").select((F.col("l_suppkey") % 20).cast("string").alias("ctg"), F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + 1).alias("end"))
    return gvcf.difference_regions(v, low, contigs, n=50)


@query(f"""WITH {_CALLS}, bed AS (SELECT DISTINCT ctg, pos // 700 * 700 AS s, pos // 700 * 700 + 300 AS e FROM w), a AS (SELECT *, 0 AS source FROM w WHERE l_returnflag = 'A' AND NOT EXISTS (SELECT 1 FROM bed b WHERE b.ctg = w.ctg AND b.s <= w.pos AND w.pos < b.e)), b AS (SELECT *, 1 AS source FROM w WHERE l_returnflag = 'R'),
u AS (SELECT *, min(source) OVER (PARTITION BY ctg, pos, alt) AS first FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) SELECT ctg, pos, array_to_string(alt, ',') AS alt, fo AS file_order FROM u WHERE source = first""")
def replace_in_regions(spark, sf_dir):
    rows, _, _ = _calls(spark, sf_dir)
    bed = rows.select("ctg", (F.floor(F.col("pos") / 700) * 700).alias("start")).distinct().select("ctg", "start", (F.col("start") + 300).alias("end"))
    found = patch.replace_in_regions(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag = 'R'"), bed)
    return found.select("ctg", "pos", F.array_join("alt", ",").alias("alt"), "file_order")


@query(f"""WITH {_CALLS}, j AS (SELECT coalesce(p.ctg, d1.ctg, d2.ctg) AS ctg, coalesce(p.pos, d1.pos, d2.pos) AS pos, p, d1, d2 FROM {_FIRST.format("l_linenumber % 3 = 0")} p FULL JOIN {_FIRST.format("l_linenumber % 3 = 1")} d1 ON p.ctg = d1.ctg AND p.pos = d1.pos FULL JOIN {_FIRST.format("l_linenumber % 3 = 2")} d2 ON coalesce(p.ctg, d1.ctg) = d2.ctg AND coalesce(p.pos, d1.pos) = d2.pos),
h AS (SELECT ctg, pos, CASE WHEN d1.hgt IS NOT NULL THEN d1 END AS d1, CASE WHEN d2.hgt IS NOT NULL THEN d2 END AS d2, p, p.fo IS NOT NULL AND p.k % 3 = 0 AS one, p.fo IS NOT NULL AND p.k % 3 <> 2 AS two FROM j),
x AS (SELECT *, d1.fo IS NOT NULL AND (NOT one OR list_contains(d1.alt, p.alt[1])) AS u1, d2.fo IS NOT NULL AND (NOT two OR list_contains(d2.alt, p.alt[1])) AS u2 FROM h),
y AS (SELECT ctg, pos, 1 AS hap, u1 AS use, CASE WHEN u1 THEN d1.n ELSE 1 END AS n, CASE WHEN u1 THEN d1.alt ELSE [p.alt[1]] END AS alt, CASE WHEN u1 THEN d1.hpl ELSE [p.dpl[1], p.dpl[3]] END AS pl, CASE WHEN u1 THEN d1.gq ELSE p.gq END AS gq, CASE WHEN u1 THEN d1.hgt ELSE '1' END AS gt, CASE WHEN u1 THEN d1.rpa ELSE p.rpa[1:2] END AS rpa, CASE WHEN u1 THEN d1.delta ELSE p.delta END AS delta FROM x WHERE u1 OR one
 UNION ALL SELECT ctg, pos, 2, u2, CASE WHEN u2 THEN d2.n ELSE 1 END, CASE WHEN u2 THEN d2.alt ELSE [p.alt[1]] END, CASE WHEN u2 THEN d2.hpl ELSE [p.dpl[1], p.dpl[3]] END, CASE WHEN u2 THEN d2.gq ELSE p.gq END, CASE WHEN u2 THEN d2.hgt ELSE '1' END, CASE WHEN u2 THEN d2.rpa ELSE p.rpa[1:2] END, CASE WHEN u2 THEN d2.delta ELSE p.delta END FROM x WHERE u2 OR two),
z AS (SELECT *, CASE WHEN n > 2 THEN [0, s[1].i, s[2].i] ELSE range(0, n + 1) END AS keep, bool_and(pl[1] = 0 AND gq >= 20) OVER (PARTITION BY ctg, pos) AS sure FROM (SELECT *, list_sort([{{'p': pl[i + 1], 'i': i}} FOR i IN range(1, n + 1)]) AS s FROM y))
SELECT hap, ctg, pos, array_to_string([alt[i] FOR i IN keep IF i > 0], ',') AS alt, CASE WHEN n > 2 THEN CAST(greatest(coalesce(list_position(keep, CAST(gt AS BIGINT)), 0) - 1, 0) AS VARCHAR) ELSE gt END AS "GT", gq AS "GQ", array_to_string([pl[i + 1] FOR i IN keep], ',') AS "PL", array_to_string([rpa[i + 1] FOR i IN keep], ',') AS "RPA", CASE WHEN use OR delta THEN true END AS "DELTA", 0 AS filters FROM z WHERE NOT sure""")
def patch_haploid_pair(spark, sf_dir):
    rows, haploid, _ = _calls(spark, sf_dir)
    part = lambda m: rows.where(F.col("l_linenumber") % 3 == m)
    turned = (F.floor(F.col("file_order") / 100_000_000) - F.col("l_linenumber")) / 8 % 3  # the part, modulo 3
    phased = part(0).withColumns({"PL": F.col("dPL"), "GT": F.when(turned == 0, "1|1").when(turned == 1, "0|1").otherwise("0/1")})
    return _plain(patch.patch_both_haplotypes(haploid(part(1)), haploid(part(2)), phased=phased), "hap")


@query("""WITH w AS (SELECT l_orderkey, l_partkey, l_linenumber, l_partkey % 4 AS k FROM lineitem), v AS (SELECT *, CASE k WHEN 0 THEN 'A' ELSE 'AC' END AS ref, CASE k WHEN 0 THEN ['C', 'G'] WHEN 1 THEN ['GC', 'T'] WHEN 2 THEN ['T', 'GC'] ELSE ['AT', 'GC'] END AS alt, ['0/1', '1/2', '0/2', '0/0', '2|2'][l_orderkey % 5 + 1] AS gt FROM w WHERE l_orderkey % 5 <> 3),
u AS (SELECT *, CASE gt WHEN '0/1' THEN [1] WHEN '1/2' THEN [1, 2] ELSE [2] END AS used FROM v), t AS (SELECT *, [alt[i] FOR i IN used] AS kept FROM u), n AS (SELECT *, CASE WHEN ref = 'AC' AND list_bool_and([length(x) > 1 AND right(x, 1) = 'C' FOR x IN kept]) THEN 1 ELSE 0 END AS cut FROM t)
SELECT l_orderkey, l_partkey, l_linenumber, left(ref, length(ref) - cut) AS ref, array_to_string([left(x, length(x) - cut) FOR x IN kept], ',') AS alt, CASE gt WHEN '1/2' THEN '1/2' WHEN '2|2' THEN '1/1' ELSE '0/1' END AS "GT" FROM n""")
def finalise(spark, sf_dir):
    k = F.col("l_partkey") % 4
    v = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.when(k == 0, "A").otherwise("AC").alias("ref"), F.when(k == 0, _list("C", "G")).when(k == 1, _list("GC", "T")).when(k == 2, _list("T", "GC")).otherwise(_list("AT", "GC")).alias("alt"), F.get(_list("0/1", "1/2", "0/2", "0/0", "2|2"), (F.col("l_orderkey") % 5).cast("int")).alias("GT"))
    return gvcf.finalise(v).select("l_orderkey", "l_partkey", "l_linenumber", "ref", F.array_join("alt", ",").alias("alt"), "GT")


@query("""WITH v AS (SELECT l_orderkey, l_partkey, l_linenumber, l_partkey % 3 AS k, ['0/1', '0/0', '1/1'][l_orderkey % 3 + 1] AS gt, CAST(l_quantity AS INTEGER) AS q FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, CASE k WHEN 1 THEN 'C' ELSE 'C,G' END AS alt, gt AS "GT", CASE k WHEN 1 THEN q || ',1,2' ELSE q || ',1,2,4,5,7' END AS "PL", CASE k WHEN 1 THEN '1,2' ELSE '1,2,4' END AS "AD" FROM v WHERE k > 0 AND gt <> '0/0'""")
def gvcf_to_calls(spark, sf_dir):
    k, q = F.col("l_partkey") % 3, F.col("l_quantity").cast("int")
    ints = lambda *x: F.array(*[F.lit(v) if isinstance(v, int) else v for v in x])
    v = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.when(k == 0, _list(gvcf.NON_REF)).when(k == 1, _list("C", gvcf.NON_REF)).otherwise(_list("C", gvcf.NON_REF, "G")).alias("alt"), F.get(_list("0/1", "0/0", "1/1"), (F.col("l_orderkey") % 3).cast("int")).alias("GT"), F.when(k == 0, ints(q, 1, 2)).when(k == 1, ints(q, 1, 2, 3, 4, 5)).otherwise(ints(q, 1, 2, 3, 6, 8, 4, 5, 9, 7)).alias("PL"), F.when(k == 0, ints(1, 2)).when(k == 1, ints(1, 2, 3)).otherwise(ints(1, 2, 3, 4)).alias("AD"))
    text_of = lambda c: F.array_join(c, ",").alias(c)
    return gvcf.gvcf_to_calls(v).select("l_orderkey", "l_partkey", "l_linenumber", text_of("alt"), "GT", text_of("PL"), text_of("AD"))


@query("""WITH r AS (SELECT l_orderkey AS read_id, l_linenumber % 3 AS no, CASE WHEN l_partkey % 5 = 0 THEN 256 ELSE l_partkey % 5 END AS flag, l_partkey AS k FROM lineitem), p AS (SELECT *, row_number() OVER (PARTITION BY read_id, no ORDER BY flag, k) AS n FROM r WHERE flag & 2304 = 0)
SELECT read_id, max(k) FILTER (no = 1 AND n = 1) AS first, max(k) FILTER (no = 2 AND n = 1) AS second FROM p GROUP BY read_id""")
def collated_reads(spark, sf_dir):
    k = F.col("l_partkey")
    reads = _table(spark, sf_dir, "lineitem").select(k.alias("k"), F.col("l_orderkey").alias("read_id"), (F.col("l_linenumber") % 3).alias("read_no"), F.when(k % 5 == 0, 256).otherwise(k % 5).alias("flag"))
    return aggregates.collate(reads).select("read_id", F.col("first.k").alias("first"), F.col("second.k").alias("second"))


@query("""WITH w AS (SELECT CAST(l_suppkey AS VARCHAR) AS ctg, l_orderkey AS pos, min((l_partkey, CAST(l_quantity AS INTEGER))) AS m FROM lineitem GROUP BY 1, 2), v AS (SELECT ctg, pos, m[1] AS k, m[2] AS q FROM w)
SELECT ctg, pos, pos + 2 AS "end", CASE WHEN k % 3 > 0 THEN 'rs' || k ELSE '.' END AS id, 'AC' AS ref, CASE WHEN k % 2 = 0 THEN 'A,GC' ELSE 'A' END AS alt, CASE WHEN k % 7 > 0 THEN CAST(q + 0.5 AS DOUBLE) END AS qual, CASE WHEN k % 5 = 0 THEN 'low' WHEN k % 5 = 1 THEN 'PASS' ELSE '' END AS filter, CAST(q AS VARCHAR) AS dp, k % 4 = 0 AS repeat, '0/1' AS "GT", CASE WHEN k % 6 > 0 THEN q || ',0,' || k % 90 END AS "PL" FROM v""")
def vcf_round_trip(spark, sf_dir):
    """Calls from line items written as VCF text and read back."""
    w = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("ctg"), F.col("l_orderkey").alias("pos")).agg(F.min(F.struct("l_partkey", F.col("l_quantity").cast("int").alias("q"))).alias("m"))
    k, q = F.col("k"), F.col("q")
    texts = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    v = w.select("ctg", "pos", F.col("m.l_partkey").alias("k"), "m.q").select(
        "ctg", "pos", (F.col("pos") + 2).alias("end"), F.when(k % 3 > 0, F.concat(F.lit("rs"), k)).alias("id"), F.lit("AC").alias("ref"), F.when(k % 2 == 0, texts("A", "GC")).otherwise(texts("A")).alias("alt"), F.when(k % 7 > 0, q + F.lit(0.5)).alias("qual"), F.when(k % 5 == 0, texts("low")).when(k % 5 == 1, texts("PASS")).otherwise(texts()).alias("filter"),
        F.when(k % 4 == 0, F.map_from_arrays(texts("DP", "STR"), F.array(q.cast("string"), F.lit(None).cast("string")))).otherwise(F.create_map(F.lit("DP"), q.cast("string"))).alias("info"), texts("GT", "PL").alias("format"), F.array(F.create_map(F.lit("GT"), F.lit("0/1"), F.lit("PL"), F.when(k % 6 > 0, F.concat_ws(",", q, F.lit(0), k % 90)).otherwise("."))).alias("samples"),
    )
    header = spark.range(1).select(F.explode(texts("##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS")).alias("value"))
    contigs = v.groupBy("ctg").agg(F.max("end").alias("length")).withColumn("ctg_idx", F.col("ctg").cast("long"))
    path = _scratch(spark, "vcf")
    text.write_vcf(v, header, contigs, path)
    back, _ = text.read_vcf(spark, f"{path}/records")
    return back.select("ctg", "pos", "end", "id", "ref", F.array_join("alt", ",").alias("alt"), "qual", F.array_join("filter", ";").alias("filter"), F.col("info")["DP"].alias("dp"), F.map_contains_key("info", "STR").alias("repeat"), "GT", F.array_join(text.sample_array("PL"), ",").alias("PL"))


@query(f"""WITH iv AS ({_IV}) SELECT CAST(ctg AS VARCHAR) AS ctg, "start", "end", count(*) AS n FROM iv GROUP BY 1, 2, 3""")
def bed_round_trip(spark, sf_dir):
    """Regions written as text and read back, with three columns and with four; how often each is there."""
    iv = _iv(spark, sf_dir).select(F.col("ctg").cast("string").alias("ctg"), "start", "end", F.lit(1).alias("n"))
    path = _scratch(spark, "bed")
    text.write_bed(iv, path)
    three = text.read_bed(spark, path).groupBy("ctg", "start", "end").agg(F.count("*").alias("n"))
    four = text.read_bed4(spark, path).groupBy("ctg", "start", "end").agg(F.sum("n").alias("m"))
    return three.join(four, ["ctg", "start", "end"]).where("n = m").drop("m")


@query(f"""WITH d AS ({_DNA}), s AS (SELECT doc_id, seq FROM d WHERE length(seq) > 0) SELECT doc_id, length(seq) AS bases, substr(seq, CAST(length(seq) // 3 + 1 AS BIGINT), 50) AS piece, md5(seq) AS digest FROM s""")
def fasta_round_trip(spark, sf_dir):
    """Sequences written as FASTA lines of 60 bases, read as chunks; a slice of each, and the digest of all its chunks."""
    dna = _dna(spark, sf_dir).where("length(seq) > 0").select("doc_id", "seq")
    lines = F.concat(F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" text\n")), F.regexp_replace("seq", "(.{60})(?=.)", "$1\n"))
    path = _scratch(spark, "fasta")
    dna.select(lines.alias("value")).write.text(path)
    chunks = text.read_fasta(spark, path, chunk=256)
    whole = chunks.groupBy("ctg").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "seq"))), lambda x: x["seq"]), "").alias("all"))
    wanted = dna.select(F.col("doc_id").cast("string").alias("vid"), F.col("doc_id").cast("string").alias("ctg"), F.floor(F.length("seq") / 3).cast("long").alias("start"), F.least(F.floor(F.length("seq") / 3) + 50, F.length("seq")).cast("long").alias("end"))
    pieces = text.ref_slice(wanted, chunks, "vid", chunk=256).select("ctg", F.col("bases").alias("piece"))
    return whole.join(pieces, "ctg").select(F.col("ctg").cast("long").alias("doc_id"), F.length("all").alias("bases"), "piece", F.md5(F.col("all").cast("binary")).alias("digest"))


@query("""SELECT 'r' || l_orderkey || '.' || l_linenumber || '.' || l_partkey AS read_id, repeat('ACGT', CAST(l_linenumber AS INTEGER)) AS seq, repeat('@I+>', CAST(l_linenumber AS INTEGER)) AS qual FROM lineitem""")
def fastq_round_trip(spark, sf_dir):
    """Reads written as gzipped FASTQ, whose qualities begin like names, and read back."""
    n = F.col("l_linenumber").cast("int")
    record = F.concat_ws("\n", F.concat(F.lit("@r"), F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey"), F.lit(" x")), F.repeat(F.lit("ACGT"), n), F.lit("+"), F.repeat(F.lit("@I+>"), n))
    path = _scratch(spark, "fastq")
    _table(spark, sf_dir, "lineitem").select(record.alias("value")).write.option("compression", "gzip").text(path)
    return text.read_fastq(spark, path)


@query("""WITH l AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(l_suppkey AS VARCHAR) AS ctg, CAST(n / 8.0 AS VARCHAR) AS normalized_coverage, CAST(n % 4 AS VARCHAR) AS ploidy, 'female' AS sex FROM l""")
def ploidy_json(spark, sf_dir):
    """Ploidies written as nested JSON and read back."""
    rows = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("ctg")).agg(F.count("*").alias("n"))
    found = rows.select("ctg", (F.col("n") / 8).alias("normalized_coverage"), (F.col("n") % 4).cast("string").alias("ploidy"))
    path = _scratch(spark, "json")
    text.write_ploidy_json(found, spark.range(1).select(F.lit("female").alias("sex")), path)
    back = text.read_ploidy_json(spark, path)
    return back.select("sex", F.explode("contigs").alias("ctg", "v")).select("ctg", "v.normalized_coverage", "v.ploidy", "sex")


@query(f"""WITH {_CALLS}, {_JOINED.format("d.hgt IS NOT NULL", _FIRST.format("l_returnflag = 'A'"), _FIRST.format("l_returnflag = 'R'"))},
y AS (SELECT *, list_sort([{{'p': x.hpl[i + 1], 'i': i}} FOR i IN range(1, x.n + 1)]) AS s FROM x),
z AS (SELECT *, CASE WHEN x.n > 2 THEN [0, s[1].i, s[2].i] ELSE range(0, x.n + 1) END AS keep FROM y)
SELECT ctg, pos, pos + 1 AS "end", array_to_string([x.alt[i] FOR i IN keep IF i > 0], ',') AS alt, CASE WHEN x.n > 2 AND x.hgt IS NOT NULL THEN CAST(greatest(coalesce(list_position(keep, CAST(x.hgt AS BIGINT)), 0) - 1, 0) AS VARCHAR) ELSE x.hgt END AS "GT", CAST(x.gq AS VARCHAR) AS "GQ",
 array_to_string([x.hpl[i + 1] FOR i IN keep], ',') AS "PL", array_to_string([x.rpa[i + 1] FOR i IN keep], ',') AS "RPA", use OR x.delta OR (x.str AND x.rpa[1] >= 4) AS "DELTA", x.str AS repeat, CAST(x.fo AS VARCHAR) AS own, CAST(x.k AS VARCHAR) AS further FROM z WHERE NOT (x.hpl[1] = 0 AND x.gq >= 20)""")
def patch_vcf_text(spark, sf_dir):
    """Two call sets as VCF text, read, patched, written and read again; a field of INFO and one of FORMAT that patching does not know stay."""
    rows, haploid, _ = _calls(spark, sf_dir)
    contigs = rows.select("ctg").distinct().withColumn("ctg_idx", F.col("ctg").cast("long"))
    header = spark.range(1).select(F.lit("##fileformat=VCFv4.2").alias("value"))
    part = F.floor(F.floor(F.col("file_order") / 100_000_000) / 8)
    more = haploid(rows).withColumns({"info": F.create_map(F.lit("OWN"), F.col("file_order").cast("string")), "sample": F.create_map(F.lit("ZZ"), part.cast("string")), "first": F.col("file_order")})

    def through_text(calls: DataFrame, name: str) -> DataFrame:
        path = _scratch(spark, name)
        text.write_vcf(patch.to_vcf(calls), header, contigs, path)
        return text.read_vcf(spark, f"{path}/records")[0]

    def stored(flag: str) -> DataFrame:
        read = patch.from_vcf(through_text(patch.calls(more.where(F.col("l_returnflag") == flag)), f"calls-{flag}"))
        return read.withColumn("file_order", F.col("info")["OWN"].cast("long"))  # the order in which the table has them

    v = through_text(patch.patch_haploid(stored("A"), stored("R")), "patched")
    s = F.get("samples", F.lit(0))
    return v.select("ctg", "pos", "end", F.array_join("alt", ",").alias("alt"), "GT", s["GQ"].alias("GQ"), s["PL"].alias("PL"), F.col("info")["RPA"].alias("RPA"), F.map_contains_key("info", "DELTA").alias("DELTA"), F.map_contains_key("info", "STR").alias("repeat"), F.col("info")["OWN"].alias("own"), s["ZZ"].alias("further"))


# The header of the stand-in calls.
_TRANSFER_HEADER = [
    '##INFO=<ID=AF,Number=A,Type=Float,Description="frequency">', '##INFO=<ID=AC,Number=A,Type=Integer,Description="count, of ALT">', '##INFO=<ID=RC,Number=R,Type=Integer,Description="depth">', '##INFO=<ID=MQ,Number=1,Type=Float,Description="quality">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="known">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="genotype">', '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="depth">', '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="likelihood">', '##FORMAT=<ID=XA,Number=A,Type=Integer,Description="by ALT">', '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="depth">',
]


@query("""WITH w AS (SELECT l_orderkey AS pos, l_linenumber, l_partkey AS k, CAST(l_suppkey % 3 AS VARCHAR) AS ctg, CAST(l_quantity AS BIGINT) AS q FROM lineitem), p AS (SELECT ctg, pos, sum(q) AS ac, sum(q) FILTER (k % 2 = 0) AS even FROM w WHERE k % 3 = 0 GROUP BY ctg, pos),
v AS (SELECT *, ['G', 'T', '<NON_REF>'][1:k % 3 + 1] AS alt, CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN ['0.5', '.', '.'] WHEN 2 THEN ['.', '0.5', '.'] ELSE ['0.1', '0.2', '.'] END[1:k % 3 + 1] AS af FROM w WHERE k % 3 > 0 AND l_linenumber <> 5),
x AS (SELECT *, list_contains(alt, '<NON_REF>') AS nr, len(alt) AS m FROM v),
y AS (SELECT *, [i FOR i IN range(1, m + 1) IF nr OR af[i] <> '.'] AS keep, list_concat([0], [i FOR i IN range(1, m + 1) IF nr OR af[i] <> '.']) AS all0, [k % 9 + i FOR i IN range(0, m + 1)] AS ad, [k * t % 37 FOR t IN range(1, CASE WHEN k % 5 = 0 THEN m + 2 ELSE (m + 1) * (m + 2) // 2 + 1 END)] AS pl FROM x WHERE nr OR af IS NOT NULL)
SELECT y.pos, l_linenumber, k, y.ctg, array_to_string([alt[i] FOR i IN keep], ',') AS alt, array_to_string([coalesce(CAST(CASE i WHEN 1 THEN p.ac WHEN 2 THEN p.even END AS VARCHAR), '-') FOR i IN keep], ',') AS pop,
 CASE WHEN k % 7 = 0 THEN '.' ELSE array_to_string([ad[i] * 2 FOR i IN keep], ',') END AS "AC", array_to_string([af[i] FOR i IN keep], ',') AS "AF", array_to_string([ad[i + 1] * 3 FOR i IN all0], ',') AS "RC", CAST(k % 60 AS VARCHAR) AS "MQ", true AS "DB", 5 - CAST(af IS NULL AS INTEGER) AS fields,
 '0/1' AS "GT", array_to_string([ad[i + 1] FOR i IN all0], ',') AS "AD", CASE WHEN k % 5 = 0 THEN array_to_string([pl[i + 1] FOR i IN all0], ',') ELSE array_to_string(flatten([[pl[all0[b] * (all0[b] + 1) // 2 + all0[a] + 1] FOR a IN range(1, b + 1)] FOR b IN range(1, len(all0) + 1)]), ',') END AS "PL", array_to_string([ad[i] FOR i IN keep], ',') AS "XA", CAST(q AS VARCHAR) AS "DP", '.' AS second
 FROM y LEFT JOIN p ON y.ctg = p.ctg AND y.pos = p.pos""")
def transfer(spark, sf_dir):
    """Population counts on calls with a frequency of their own; ALTs without one go, and with them their values in INFO and the samples."""
    k = F.col("l_partkey")
    items = _table(spark, sf_dir, "lineitem").withColumns({"ctg": (F.col("l_suppkey") % 3).cast("string"), "ref": F.lit("A"), "q": F.col("l_quantity").cast("long")})
    pop = items.where(k % 3 == 0).select("ctg", F.col("l_orderkey").alias("pos"), "ref", F.when(k % 2 == 0, _list("G", "T")).otherwise(_list("G")).alias("alt"), F.array("q", "q").alias("AC"))
    m = (k % 3 + 1).cast("int")
    cut = lambda values, n: F.array_join(F.slice(values, F.lit(1), n), ",")
    af = F.when(k % 4 == 1, _list("0.5", ".", ".")).when(k % 4 == 2, _list(".", "0.5", ".")).when(k % 4 == 3, _list("0.1", "0.2", "."))
    ad = lambda times=1: F.transform(A.upto(F.lit(4)), lambda i: (k % 9 + i) * times)
    likely = cut(F.transform(A.upto(F.lit(10)), lambda t: k * (t + 1) % 37), F.when(k % 5 == 0, m + 1).otherwise(((m + 1) * (m + 2) / 2).cast("int")))
    info = F.create_map(*map(F.lit, ("DB",)), F.lit(None).cast("string"), F.lit("MQ"), (k % 60).cast("string"), F.lit("AC"), F.when(k % 7 == 0, ".").otherwise(cut(ad(2), m)), F.lit("RC"), cut(ad(3), m + 1))
    info = F.when(af.isNull(), info).otherwise(F.map_concat(info, F.create_map(F.lit("AF"), cut(af, m))))
    one = F.create_map(F.lit("GT"), F.lit("0/1"), F.lit("AD"), cut(ad(), m + 1), F.lit("PL"), likely, F.lit("XA"), cut(ad(), m), F.lit("DP"), F.col("q").cast("string"))
    two = F.create_map(F.lit("GT"), F.lit("0/0"), F.lit("PL"), F.lit("."))
    raw = items.where(k % 3 > 0).select(F.monotonically_increasing_id().alias("vid"), "ctg", F.col("l_orderkey").alias("pos"), "l_linenumber", k.alias("k"), "ref", F.slice(_list("G", "T", gvcf.NON_REF), F.lit(1), m).alias("alt"), F.when(F.col("l_linenumber") != 5, _list("GT")).otherwise(F.array().cast("array<string>")).alias("format"), info.alias("info"), F.array(one, two).alias("samples"))
    header = spark.createDataFrame([(x,) for x in _TRANSFER_HEADER], "value string")
    found = gvcf.transfer(raw, pop, "vid", {"AC": "sum"}, text.field_numbers(header, "INFO"), text.field_numbers(header, "FORMAT"))
    s = F.get("samples", F.lit(0))
    own = [F.col("info")[c].alias(c) for c in ("AC", "AF", "RC", "MQ")] + [s[c].alias(c) for c in ("GT", "AD", "PL", "XA", "DP")]
    flag = F.map_contains_key("info", "DB") & F.col("info")["DB"].isNull()
    return found.select("pos", "l_linenumber", "k", "ctg", F.array_join("alt", ",").alias("alt"), F.array_join(F.transform("pop_AC", lambda x: F.coalesce(x.cast("string"), F.lit("-"))), ",").alias("pop"), *own, flag.alias("DB"), F.size("info").alias("fields"), F.get("samples", F.lit(1))["PL"].alias("second"))

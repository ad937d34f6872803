"""Registered queries for repeats in long alleles, on sequences made from documents, with SQL for the same rows.

The SQL counts common subsequences with the bits of one number, so its sequences stay
under 126 bases; the shortest sequence and the steps are parameters of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from ..operators.normalise import left_align as moved_left
from . import cnv
from .queries import _DNA, _dna, query

#: Shortest sequence, and bases from lag to lag and from split to split.
_LEAST, _STEP, _SPLIT = 16, 5, 4
#: Bases in a chunk of a contig.
_CHUNK = 64


def _scored(source: str, name: str) -> str:
    """CTEs: ``name`` is ``source (a, b, ...)`` with ``ratio``, the similarity of a and b."""
    return f"""{name}_m AS (SELECT *, [coalesce(list_sum([CASE WHEN substr(a, k + 1, 1) = x THEN 1::HUGEINT << k ELSE 0::HUGEINT END FOR k IN range(0, length(a))]), 0)::HUGEINT FOR x IN ['A', 'C', 'G', 'T']] AS masks, (1::HUGEINT << length(a)) - 1 AS ones FROM {source}),
{name} AS (SELECT * EXCLUDE (masks, ones), CASE WHEN a = b THEN 1::DOUBLE WHEN length(a) * length(b) = 0 THEN 0::DOUBLE ELSE (2 * (length(a) - bit_count(list_reduce(list_prepend(ones, [strpos('ACGT', x)::HUGEINT FOR x IN string_split(b, '')]), lambda row, c: ((row + (row & masks[c::BIGINT])) | (row - (row & masks[c::BIGINT]))) & ones))))::DOUBLE / (length(a) + length(b)) END AS ratio FROM {name}_m)"""


_REPEATS = f"""d AS ({_DNA}), u AS (SELECT doc_id AS id, seq, substr(seq, 1, CAST(20 + doc_id % 7 * 6 AS INTEGER)) AS unit FROM d),
s AS (SELECT id, CASE WHEN id % 5 = 4 THEN substr(seq, 1, 120) WHEN id % 2 = 0 THEN substr(repeat(unit, CAST(2 + id % 3 AS INTEGER)), 1, 150) ELSE substr(unit || substr(unit, 1, 9) || substr(unit, 11) || repeat(unit, CAST(id % 3 AS INTEGER)), 1, 150) END AS seq FROM u),
s0 AS (SELECT id, seq, length(seq) AS n, CASE WHEN length(seq) > {20 * _STEP} THEN {2 * _STEP} ELSE {_STEP} END AS st FROM s WHERE length(seq) >= {_LEAST})"""
_BEST = "SELECT w{0}.*, (SELECT max(ratio) FROM g WHERE g.id = w{0}.id AND g.p BETWEEN lo AND hi AND (g.p - lo) % step = 0) AS top FROM w{0}"
# A round: the best of the tried periods (of equals the first), then a finer range around it; done when the step is one base.
_ROUND = "b{0} AS (SELECT *, (SELECT min(p) FROM g WHERE g.id = x.id AND g.p BETWEEN lo AND hi AND (g.p - lo) % step = 0 AND ratio = top) AS best FROM (" + _BEST + ") x), w{1} AS (SELECT id, n, st, period, k, CASE WHEN step = 1 THEN lo ELSE best - 2 * step END AS lo, CASE WHEN step = 1 THEN hi ELSE best + 2 * step END AS hi, CASE WHEN step = 1 THEN 1 ELSE greatest(1, 4 * step // 10) END AS step FROM b{0})"


@query(f"""WITH RECURSIVE {_REPEATS},
lag AS (SELECT id, st, l, substr(seq, 1, CAST(l AS INTEGER)) AS a, substr(seq, CAST(l + 1 AS INTEGER), CAST(l AS INTEGER)) AS b FROM (SELECT *, unnest(range(2 * st, least(n // 2 + st * 5, n - st), st)) AS l FROM s0)),
{_scored("lag", "lr")},
pr AS (SELECT id, (l // st) - 2 AS i, CASE WHEN ratio < 0.9 THEN 0 ELSE ratio END AS y FROM lr),
e AS (SELECT *, CASE WHEN lag(y) OVER w IS DISTINCT FROM y THEN 1 ELSE 0 END AS new FROM pr WINDOW w AS (PARTITION BY id ORDER BY i)),
f AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM e),
r AS (SELECT id, run, any_value(y) AS y, min(i) AS a, max(i) AS b FROM f GROUP BY id, run),
t AS (SELECT *, lag(y) OVER w AS before, lead(y) OVER w AS after FROM r WINDOW w AS (PARTITION BY id ORDER BY run)),
o AS (SELECT id, (a + b) // 2 AS peak, row_number() OVER (PARTITION BY id ORDER BY y DESC, a + b) AS k FROM t WHERE before < y AND after < y AND y >= 0.95),
q AS (SELECT id, 0 AS k, CAST([] AS BIGINT[]) AS kept FROM s0 UNION ALL SELECT q.id, q.k + 1, CASE WHEN len(list_filter(kept, lambda x: abs(x - peak) < 2)) > 0 THEN kept ELSE list_append(kept, peak) END FROM q JOIN o ON q.id = o.id AND o.k = q.k + 1),
pk AS (SELECT id, list_sort(arg_max(kept, k)) AS kept FROM q GROUP BY id),
top AS (SELECT id, max(y) AS top FROM pr GROUP BY id),
half AS (SELECT id, substr(seq, 1, n // 2) AS a, substr(seq, n // 2 + 1, n // 2) AS b FROM s0), {_scored("half", "hr")},
pt AS (SELECT s0.*, top, CASE WHEN len(kept) > 0 THEN [(x + 2)::DOUBLE FOR x IN kept] WHEN top IS NOT NULL AND hr.ratio > 0.9 THEN [(n // 2)::DOUBLE / st] ELSE CAST([] AS DOUBLE[]) END AS tops FROM s0 JOIN pk USING (id) JOIN hr USING (id) LEFT JOIN top USING (id)),
un AS (SELECT *, list_min(list_append([tops[i + 1] - tops[i] FOR i IN range(1, len(tops))], tops[1])) AS unit FROM pt WHERE len(tops) > 0 AND top >= 0.9),
fit AS (SELECT *, CAST(floor(st * CASE WHEN len(tops) > 1 THEN list_sum([round_even(x / unit, 0) * x FOR x IN tops]) / list_sum([round_even(x / unit, 0) * round_even(x / unit, 0) FOR x IN tops]) ELSE tops[1] END) AS BIGINT) AS period FROM un),
w0 AS (SELECT id, n, st, period, k, lo, hi, greatest(1, (hi - lo) // 10) AS step FROM (SELECT *, CAST(floor(n / (k + 0.5)) AS BIGINT) AS lo, CAST(floor(n / (k - 0.5)) AS BIGINT) AS hi FROM (SELECT *, CAST(round_even(n / period, 0) AS BIGINT) AS k FROM fit) WHERE k >= 2)),
every AS (SELECT id, n, k, unnest(list_distinct(list_concat(range(greatest(1, lo - 2 * step), hi + 2 * step + 1), [period]))) AS p FROM w0),
parts AS (SELECT every.id, p, substr(seq, CAST(i * p + 1 AS INTEGER), CAST(p AS INTEGER)) AS a, substr(seq, CAST((i + 1) * p + 1 AS INTEGER), CAST(p AS INTEGER)) AS b FROM (SELECT *, unnest(range(0, k - 1)) AS i FROM every) every JOIN s0 USING (id)), {_scored("parts", "ps")},
g AS MATERIALIZED (SELECT id, p, max(ratio) AS ratio FROM ps GROUP BY id, p),
{", ".join(_ROUND.format(i, i + 1) for i in range(3))}, b3 AS (SELECT *, (SELECT min(p) FROM g WHERE g.id = x.id AND g.p BETWEEN lo AND hi AND (g.p - lo) % step = 0 AND ratio = top) AS best FROM ({_BEST.format(3)}) x),
fst AS (SELECT b3.id, b3.n, CASE WHEN b3.top > g.ratio THEN b3.best ELSE period END AS period, greatest(b3.top, g.ratio) AS ratio FROM b3 JOIN g ON g.id = b3.id AND g.p = period),
mu AS (SELECT id, m * period AS p, CAST(round_even(n / (m * period), 0) AS BIGINT) AS k FROM (SELECT *, unnest(range(2, n // (2 * period) + 1)) AS m FROM fst)),
mp AS (SELECT mu.id, p, substr(seq, CAST(i * p + 1 AS INTEGER), CAST(p AS INTEGER)) AS a, substr(seq, CAST((i + 1) * p + 1 AS INTEGER), CAST(p AS INTEGER)) AS b FROM (SELECT *, unnest(range(0, k - 1)) AS i FROM mu WHERE k > 1) mu JOIN s0 USING (id)), {_scored("mp", "ms")},
al AS (SELECT * FROM (SELECT id, period, ratio FROM fst UNION ALL SELECT id, p, max(ratio) FROM ms GROUP BY id, p) WHERE period >= {_LEAST}),
ks AS (SELECT *, max(ratio) OVER (PARTITION BY id) AS top, count(*) OVER (PARTITION BY id) AS c FROM al)
SELECT id, CAST(period AS INTEGER) AS period FROM ks WHERE c = 1 OR ratio > greatest(0.9, top - 0.03) UNION ALL SELECT id, CAST(n AS INTEGER) FROM s0 WHERE id NOT IN (SELECT id FROM w0)""")
def find_periods(spark, sf_dir) -> DataFrame:
    return cnv.find_periods(_repeats(spark, sf_dir), least=_LEAST, step=_STEP)


def _repeats(spark, sf_dir) -> DataFrame:
    """``(id, seq)``: copies of a document's first bases, some with a base less, some none."""
    d, k = _dna(spark, sf_dir), F.col("id")
    cut = lambda c, begin, n: F.substring(c, F.lit(begin), n if not isinstance(n, int) else F.lit(n))
    u = d.select(F.col("doc_id").alias("id"), "seq").withColumn("unit", cut(F.col("seq"), 1, (20 + k % 7 * 6).cast("int")))
    unit = F.col("unit")
    less = F.concat(unit, cut(unit, 1, 9), cut(unit, 11, 1000), F.repeat(unit, (k % 3).cast("int")))
    return u.select("id", F.when(k % 5 == 4, cut(F.col("seq"), 1, 120)).when(k % 2 == 0, cut(F.repeat(unit, (2 + k % 3).cast("int")), 1, 150)).otherwise(cut(less, 1, 150)).alias("seq"))


_ALLELES = f"""d AS ({_DNA}), r AS (SELECT doc_id AS id, seq, substr(seq, 1, CAST([1, 4, 30, 60][doc_id % 4 + 1] AS INTEGER)) AS ref, substr(seq, 100, 40) AS x FROM d WHERE length(seq) >= 200),
v AS (SELECT id, ref, CASE id % 5 WHEN 0 THEN [ref || x] WHEN 1 THEN [ref || x, '*', substr(ref, 1, 1)] WHEN 2 THEN [x || ref, substr(ref, 2) || x] WHEN 3 THEN [substr(ref, 1, 12), right(ref, 8), 'A'] ELSE [substr(ref, 1, 9) || substr(ref, 11) || x, substr(seq, 130, 70)] END AS alt FROM r),
a AS (SELECT id, ref, len(alt) AS n, unnest(alt) AS o, unnest(range(0, len(alt))) AS allele FROM v), b AS (SELECT *, length(ref) AS lr, length(o) AS la, length(o) < length(ref) AS del FROM a WHERE o <> '*'),
c AS (SELECT *, CASE WHEN del THEN o ELSE ref END AS short, CASE WHEN del THEN ref ELSE o END AS long FROM b WHERE n = 1 OR CASE WHEN del THEN lr > 10 AND lr - la > 10 ELSE la - lr > 10 END)"""


@query(f"""WITH {_ALLELES}, l0 AS (SELECT *, short AS a, substr(long, 1, length(short)) AS b FROM c), {_scored("l0", "l1")}, r0 AS (SELECT * EXCLUDE (a, b, ratio), ratio AS at_left, short AS a, right(long, length(short)) AS b FROM l1), {_scored("r0", "r1")},
t AS (SELECT *, CASE WHEN del THEN la > 1 AND (o = substr(ref, 1, la) OR la < 10 OR at_left > 0.9) ELSE lr < 6 OR at_left > least(0.9, 1 - 5.0::DOUBLE / lr) END AS l, CASE WHEN del THEN la > 1 AND ratio > 0.9 ELSE ratio > least(0.9, 1 - 5.0::DOUBLE / lr) END AS r FROM r1)
SELECT id AS vid, allele, CASE WHEN n > 1 AND l THEN length(short) - 1 ELSE 0 END + 100 AS pos, CASE WHEN n = 1 THEN ref WHEN l AND del THEN right(ref, lr - la) WHEN l THEN right(ref, 1) WHEN r AND del THEN substr(ref, 1, lr - la) WHEN r THEN substr(ref, 1, 1) ELSE ref END AS ref,
 CASE WHEN n = 1 THEN o WHEN l AND del THEN right(o, 1) WHEN l THEN right(o, la - lr + 1) WHEN r AND del THEN substr(ref, 1, 1) WHEN r THEN substr(o, 1, la - lr) ELSE o END AS alt, CASE WHEN n > 1 THEN '0/1' ELSE '1|1' END AS gt, CASE WHEN n > 1 THEN NOT del ELSE la > lr END AS insertion, o AS own FROM t""")
def split_alleles(spark, sf_dir) -> DataFrame:
    d, k = _dna(spark, sf_dir).where(F.length("seq") >= 200), F.col("id")
    sizes = F.array(*map(F.lit, (1, 4, 30, 60)))
    v = d.select(F.col("doc_id").alias("id"), "seq", F.substring(F.col("seq"), F.lit(1), F.get(sizes, (F.col("doc_id") % 4).cast("int"))).alias("ref"), F.substring("seq", 100, 40).alias("x"))
    ref, x = F.col("ref"), F.col("x")
    alt = F.when(k % 5 == 0, F.array(F.concat(ref, x))).when(k % 5 == 1, F.array(F.concat(ref, x), F.lit("*"), F.substring(ref, 1, 1))).when(k % 5 == 2, F.array(F.concat(x, ref), F.concat(F.substring(ref, 2, 1000), x)))
    alt = alt.when(k % 5 == 3, F.array(F.substring(ref, 1, 12), F.when(F.length(ref) > 0, F.right(ref, F.lit(8))), F.lit("A"))).otherwise(F.array(F.concat(F.substring(ref, 1, 9), F.substring(ref, 11, 1000), x), F.substring("seq", 130, 70)))
    rows = v.select(F.col("id").alias("vid"), F.lit("a").alias("ctg"), F.lit(100).cast("long").alias("pos"), (F.length(ref) + 100).cast("long").alias("end"), "ref", alt.alias("alt"), F.lit("1|1").alias("GT"))
    found = cnv.split_alleles(rows, least=10)
    return found.select("vid", F.col("allele").cast("long").alias("allele"), "pos", "ref", F.get("alt", F.lit(0)).alias("alt"), F.col("GT").alias("gt"), "insertion", "own")


_CONTIGS = f"""d AS ({_DNA}), u AS (SELECT doc_id AS id, seq, substr(seq, 80, CAST(20 + doc_id % 5 * 6 AS INTEGER)) AS unit, CAST(60 + doc_id % 17 AS INTEGER) AS before FROM d WHERE length(seq) >= 240),
c AS (SELECT *, length(unit) AS p, substr(seq, 1, before) || repeat(unit, CAST(1 + id % 4 AS INTEGER)) || substr(seq, 150, 80) AS contig, before + CASE id % 3 WHEN 0 THEN 0 WHEN 1 THEN length(unit) ELSE 7 END AS pos, id % 4 <> 3 AS insertion FROM u),
k AS (SELECT *, CASE WHEN id % 2 = 0 THEN '' ELSE substr(contig, pos, 1) END || substr(contig, pos + 1, 0) || substr(unit || unit, CASE WHEN id % 3 = 2 THEN 8 ELSE 1 END, CAST(p + id % 3 * 2 AS INTEGER)) AS alt, substr(contig, pos + 1, p) AS del FROM c)"""
_STEP_SQL = "(SELECT max(ratio) FROM g WHERE g.id = t{0}.id AND list_contains(tried, cut)) AS top"
# A round: the first of the best tried points, then one on either side at half the step.
_SPLITS = "c{0} AS (SELECT * FROM (SELECT *, [x FOR x IN tried IF list_contains(m.tops, x)][1] AS best FROM (SELECT t{0}.*, " + _STEP_SQL + ", (SELECT list(cut) FROM g WHERE g.id = t{0}.id AND list_contains(tried, cut) AND ratio = (SELECT max(ratio) FROM g h WHERE h.id = t{0}.id AND list_contains(tried, h.cut))) AS tops FROM t{0}) m) WHERE top >= 0.8), t{1} AS (SELECT id, p, step // 2 AS step, list_concat(tried, [x FOR x IN list_distinct([greatest(0, best - step // 2), least(best + step // 2, p)]) IF NOT list_contains(tried, x)]) AS tried FROM (SELECT * REPLACE (best::BIGINT AS best) FROM c{0}))"


@query(f"""WITH {_CONTIGS}, i AS (SELECT *, substr(contig, pos - p + 1, p) AS before_seq, substr(contig, pos + 1, p) AS after0, length(alt) - CAST(round_even(length(alt) / p, 0) AS INTEGER) * p AS spare FROM k WHERE insertion),
j AS (SELECT *, CASE WHEN spare > 0 THEN right(alt, spare) || after0 WHEN spare < 0 THEN substr(after0, 1 - spare) ELSE after0 END AS after, substr(alt, 1, p) AS u FROM i),
z AS (SELECT id, cut, CASE WHEN cut = p THEN after ELSE substr(after, 1, CAST(cut AS INTEGER)) || right(before_seq, CAST(p - cut AS INTEGER)) END AS a, u AS b FROM (SELECT *, unnest(range(0, p + 1)) AS cut FROM j)), {_scored("z", "zs")},
g AS MATERIALIZED (SELECT id, cut, CASE WHEN ratio < 0.8 THEN 0 ELSE ratio END AS ratio FROM zs),
t0 AS (SELECT id, p, greatest(p // 40, {_SPLIT}) AS step, list_append(range(0, p, greatest(p // 40, {_SPLIT})), p) AS tried FROM j),
{", ".join(_SPLITS.format(n, n + 1) for n in range(2))}, {_SPLITS.format(2, 3)},
hit AS (SELECT c2.id, best, top FROM c2 WHERE top >= 0.9),
m AS (SELECT j.id, j.contig, j.p, pos - (j.p - best) AS s, pos + best AS e, CASE WHEN best <> j.p THEN right(before_seq, CAST(j.p - best AS INTEGER)) || substr(alt, 1, CAST(best AS INTEGER)) ELSE u END AS unit, top AS ratio FROM hit JOIN j USING (id) UNION ALL SELECT id, contig, p, pos, pos + p, del, 1 FROM k WHERE NOT insertion),
sides AS (SELECT id, 'l' AS side, n, s - n * p AS s0, substr(contig, CAST(greatest(0, s - n * p) + 1 AS INTEGER), CAST(greatest(0, s - n * p + p - greatest(0, s - n * p)) AS INTEGER)) AS a, unit AS b FROM (SELECT *, unnest(range(1, 20)) AS n FROM m) UNION ALL SELECT id, 'r', n, e + (n - 1) * p, substr(contig, CAST(e + (n - 1) * p + 1 AS INTEGER), CAST(p AS INTEGER)), unit FROM (SELECT *, unnest(range(1, 20)) AS n FROM m)), {_scored("sides", "sr")},
bad AS (SELECT id, min(n) FILTER (side = 'l') AS l, min(n) FILTER (side = 'r') AS r FROM sr WHERE ratio < 0.9 OR s0 < 0 GROUP BY id)
SELECT m.id AS key, s AS start, e AS stop, s - (l - 1) * p AS array_start, e + (r - 1) * p AS array_stop, round(ratio, 6) AS ratio FROM m JOIN bad USING (id)""")
def local_match(spark, sf_dir) -> DataFrame:
    rows, chunks = _beside(spark, sf_dir)
    found = cnv.local_match(rows, chunks, chunk=_CHUNK, step=_SPLIT)
    return found.select(F.col("key").cast("long").alias("key"), "start", "stop", "array_start", "array_stop", F.round("ratio", 6).alias("ratio"))


def _long_dna(spark, sf_dir, least: int) -> DataFrame:
    """Bases of the documents that have ``least`` or more; the generator keeps the condition from working them out again."""
    d = _dna(spark, sf_dir).select("doc_id", F.explode(F.array("seq")).alias("seq"))
    return d.where(F.length("seq") >= least)


def _beside(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Insertions and deletions in or beside an array of a document's bases, and the documents' contigs in chunks.

    Both are read in every round of a search, so the contigs are stored.
    """
    d, k = _long_dna(spark, sf_dir, 240), F.col("id")
    cut = lambda c, begin, n: F.substring(c, begin if not isinstance(begin, int) else F.lit(begin), n if not isinstance(n, int) else F.lit(n))
    seq, unit = F.col("seq"), F.col("unit")
    u = d.select(F.col("doc_id").alias("id"), "seq").withColumns({"unit": cut(seq, 80, (20 + k % 5 * 6).cast("int")), "before": (60 + k % 17).cast("int")})
    u = u.withColumns({"p": F.length("unit"), "contig": F.concat(cut(seq, 1, F.col("before")), F.repeat(unit, (1 + k % 4).cast("int")), cut(seq, 150, 80)), "pos": F.col("before") + F.when(k % 3 == 0, 0).when(k % 3 == 1, F.length("unit")).otherwise(7), "insertion": k % 4 != 3})
    u = cnv._stored(u.drop("seq", "before"))
    alt = F.concat(F.when(k % 2 == 0, "").otherwise(cut(F.col("contig"), F.col("pos"), 1)), cut(F.concat(unit, unit), F.when(k % 3 == 2, 8).otherwise(1), (F.col("p") + k % 3 * 2).cast("int")))
    key = F.col("id").cast("string")
    rows = u.select(key.alias("key"), key.alias("ctg"), F.col("pos").cast("long").alias("pos"), cut(F.col("contig"), F.col("pos") + 1, F.col("p")).alias("ref"), alt.alias("alt"), "insertion", F.col("p").alias("period"))
    n = F.explode(F.sequence(F.lit(0), F.floor((F.length("contig") - 1) / _CHUNK).cast("int")))
    chunks = u.select(key.alias("ctg"), "contig", n.alias("chunk")).select("ctg", F.col("chunk").cast("long").alias("chunk"), cut(F.col("contig"), F.col("chunk") * _CHUNK + 1, _CHUNK).alias("seq"))
    return rows, chunks


_TANDEM = f"""d AS ({_DNA}), u AS (SELECT doc_id AS id, seq, substr(seq, 50, CAST(1 + doc_id % 3 AS INTEGER)) AS unit FROM d WHERE length(seq) >= 120),
c AS (SELECT id, unit, substr(seq, 1, 40) || repeat(unit, CAST(4 + id % 60 AS INTEGER)) || substr(seq, 60, 40) AS contig, CAST(40 + length(unit) * (2 + id % 60) AS INTEGER) AS pos FROM u),
v AS (SELECT id, contig, pos, CASE id % 6 WHEN 0 THEN [substr(contig, pos + 1, 1 + length(unit)), substr(contig, pos + 1, 1)] WHEN 1 THEN [substr(contig, pos + 1, 1), substr(contig, pos + 1, 1) || substr(contig, pos + 2, length(unit))] WHEN 2 THEN [substr(contig, pos + 1, 1 + length(unit)), substr(contig, pos + 1, 1), substr(contig, pos + 1, 1 + length(unit)) || substr(contig, pos + 2, length(unit))]
 WHEN 3 THEN [substr(contig, pos + 1, 1), unit || substr(contig, pos + 1, 1), unit || unit || substr(contig, pos + 1, 1)] WHEN 4 THEN [substr(contig, pos + 1, 4), substr(contig, pos + 1, 3) || 'A', substr(contig, pos + 1, 1)] ELSE [substr(contig, pos + 1, 3), '<DEL>'] END AS al FROM c)"""


@query(f"""WITH RECURSIVE {_TANDEM},
w AS (SELECT id, contig, pos, al, 0 AS n, id % 6 <> 5 AS open FROM v
 UNION ALL SELECT id, contig, CASE WHEN low THEN pos - 1 ELSE pos END, CASE WHEN low THEN [substr(contig, pos, 1) || x FOR x IN cut] ELSE cut END, n + 1, true FROM (SELECT *, list_min([length(x) FOR x IN al]) = 1 AS low, [substr(x, 1, length(x) - 1) FOR x IN al] AS cut FROM w WHERE open) WHERE len(list_distinct([right(x, 1) FOR x IN al])) = 1 AND (NOT low OR pos > 0)),
e AS (SELECT id, arg_max(pos, n) AS pos, arg_max(al, n) AS al FROM w GROUP BY id),
f AS (SELECT *, CASE WHEN id % 6 = 5 THEN 0 ELSE list_max([k FOR k IN range(0, list_min([length(x) FOR x IN al])) IF len(list_distinct([substr(x, 1, k) FOR x IN al])) = 1]) END AS f FROM e)
SELECT id AS vid, pos + f AS pos, pos + f + length(al[1]) - f AS "end", substr(al[1], CAST(f + 1 AS INTEGER)) AS ref, array_to_string([substr(x, CAST(f + 1 AS INTEGER)) FOR x IN al[2:]], ',') AS alt FROM f""")
def left_align(spark, sf_dir) -> DataFrame:
    d, k = _long_dna(spark, sf_dir, 120), F.col("id")
    cut = lambda c, begin, n: F.substring(c, begin if not isinstance(begin, int) else F.lit(begin), n if not isinstance(n, int) else F.lit(n))
    u = d.select(F.col("doc_id").alias("id"), "seq").withColumn("unit", cut(F.col("seq"), 50, (1 + k % 3).cast("int")))
    n, unit, contig, pos = F.length("unit"), F.col("unit"), F.col("contig"), F.col("pos")
    c = u.select("id", "unit", F.concat(cut(F.col("seq"), 1, 40), F.repeat(unit, (4 + k % 60).cast("int")), cut(F.col("seq"), 60, 40)).alias("contig"), (40 + n * (2 + k % 60)).cast("int").alias("pos"))
    c = cnv._stored(c)  # calls and contigs are read in every round
    base, more, longer = cut(contig, pos + 1, 1), cut(contig, pos + 2, n), cut(contig, pos + 1, n + 1)
    al = F.when(k % 6 == 0, F.array(longer, base)).when(k % 6 == 1, F.array(base, F.concat(base, more))).when(k % 6 == 2, F.array(longer, base, F.concat(longer, more)))
    al = al.when(k % 6 == 3, F.array(base, F.concat(unit, base), F.concat(unit, unit, base))).when(k % 6 == 4, F.array(cut(contig, pos + 1, 4), F.concat(cut(contig, pos + 1, 3), F.lit("A")), base)).otherwise(F.array(cut(contig, pos + 1, 3), F.lit("<DEL>")))
    ctg = F.col("id").cast("string").alias("ctg")
    v = c.select(F.col("id").alias("vid"), ctg, pos.cast("long").alias("pos"), al.alias("al")).select("vid", "ctg", "pos", (F.col("pos") + F.length(F.get("al", F.lit(0)))).alias("end"), F.get("al", F.lit(0)).alias("ref"), F.slice("al", 2, 9).alias("alt"))
    chunks = c.select(ctg, "contig", F.explode(F.sequence(F.lit(0), F.floor((F.length("contig") - 1) / _CHUNK).cast("int"))).alias("chunk"))
    chunks = chunks.select("ctg", F.col("chunk").cast("long").alias("chunk"), cut(contig, F.col("chunk") * _CHUNK + 1, _CHUNK).alias("seq"))
    found = moved_left(v, chunks, _CHUNK, window=16)
    return found.select("vid", "pos", "end", "ref", F.array_join("alt", ",").alias("alt"))


# The pairs that the counts of letters leave over, then the common subsequence of each.
_ALPHABET = "".join(map(chr, [*range(32, 39), *range(40, 123)]))
_PAIRS = f"""{{strings}},
cl AS (SELECT min(id) AS id, seq FROM st GROUP BY seq),
hi AS MATERIALIZED (SELECT id, seq, length(seq) AS n, [length(seq) - length(replace(seq, x, '')) FOR x IN string_split('{_ALPHABET}', '')] AS h FROM cl),
ms AS MATERIALIZED (SELECT id, (1::HUGEINT << length(seq)) - 1 AS ones, [coalesce(list_sum([CASE WHEN substr(seq, k + 1, 1) = x THEN 1::HUGEINT << k ELSE 0::HUGEINT END FOR k IN range(0, length(seq))]), 0)::HUGEINT FOR x IN string_split('{_ALPHABET}', '')] AS masks, [strpos('{_ALPHABET}', x) FOR x IN string_split(seq, '')] AS codes FROM cl),
ca AS (SELECT a.id, b.id AS id_b, a.n + b.n AS n, a.n AS na FROM hi a JOIN hi b ON a.id < b.id AND 2 * least(a.n, b.n) >= {{t}} * (a.n + b.n) AND 2 * list_sum([least(a.h[i], b.h[i]) FOR i IN range(1, {len(_ALPHABET) + 1})]) >= {{t}} * (a.n + b.n)),
sc AS (SELECT ca.id, id_b, (2 * (na - bit_count(list_reduce(list_prepend(x.ones, y.codes::HUGEINT[]), lambda row, c: ((row + (row & x.masks[c::BIGINT])) | (row - (row & x.masks[c::BIGINT]))) & x.ones))))::DOUBLE / ca.n AS ratio FROM ca JOIN ms x ON x.id = ca.id JOIN ms y ON y.id = ca.id_b)
SELECT id, id_b, round(ratio, 6) AS ratio FROM sc WHERE ratio >= {{t}} UNION ALL SELECT cl.id, st.id, 1 FROM st JOIN cl USING (seq) WHERE st.id <> cl.id"""


@query("WITH " + _PAIRS.format(t=0.9, strings="st AS (SELECT p_partkey AS id, concat_ws(' ', p_name, p_brand, p_type) AS seq FROM part)"))
def similar_pairs(spark, sf_dir) -> DataFrame:
    """Names of parts that share nine tenths of their letters in order."""
    names = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("seq"))
    return joins.similar_pairs(names, 0.9).withColumn("ratio", F.round("ratio", 6))


@query("WITH " + _PAIRS.format(t=0.96, strings=f"d AS ({_DNA}), st AS (SELECT doc_id * 3 + k AS id, substr(seq, CAST(k * 7 + 1 AS INTEGER), CAST(118 - doc_id % 3 AS INTEGER)) AS seq FROM d, range(0, 3) AS w(k) WHERE length(seq) >= 140)"))
def similar_windows(spark, sf_dir) -> DataFrame:
    """Windows of the documents' bases that share 96 of 100 in order: copies, near copies and windows of one document a few bases apart."""
    d = _dna(spark, sf_dir).where(F.length("seq") >= 140).select("doc_id", "seq", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    windows = d.select((F.col("doc_id") * 3 + F.col("k")).alias("id"), F.substring(F.col("seq"), F.col("k") * 7 + 1, (118 - F.col("doc_id") % 3).cast("int")).alias("seq"))
    windows = cnv._stored(windows)  # the documents' bases are not worked out again for classes and members
    return joins.similar_pairs(windows, 0.96, longest_short=32).withColumn("ratio", F.round("ratio", 6))

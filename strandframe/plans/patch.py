"""Patching call sets with second-pass calls, and merging haplotypes into diploid calls.

Call tables have one row for each position and input: ``ctg, pos, end, id, ref, alt,
qual, filter, GT, GQ, DP, PS, PL, AD, info_dp, STR, RU, RPA, ML_PROB, DELTA, info, sample,
file_order``. ``info`` and ``sample`` hold all further fields of a record as texts, which go
where the record goes. ``calls`` adds what a table lacks as nulls; ``from_vcf`` and
``to_vcf`` lead from a file's records to such a table and back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alleles as A
from ..operators import intervals, joins
from ..operators.filters import confident_reference
from ..sources.text import INFO_NUMBERS

_TYPES = {"ctg": "string", "pos": "long", "end": "long", "id": "string", "ref": "string", "alt": "array<string>", "qual": "double", "filter": "array<string>", "GT": "string", "GQ": "int", "DP": "int", "PS": "long", "PL": "array<int>", "AD": "array<int>", "info_dp": "int", "STR": "boolean", "RU": "string", "RPA": "array<int>", "ML_PROB": "double", "DELTA": "boolean", "info": "map<string,string>", "sample": "map<string,string>", "file_order": "long"}
FIELDS = list(_TYPES)
_OUT = [c for c in FIELDS if c != "file_order"]
#: Bases whose calls go to one task together with the intervals that hold them.
_WIDTH = 1 << 13


def calls(v: DataFrame) -> DataFrame:
    """``v`` with all columns of a call table, and no others."""
    have = set(v.columns)
    return v.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in _TYPES.items()])


def from_vcf(v: DataFrame) -> DataFrame:
    """A call table of the records of ``sources.text.read_vcf``; values that are missing or no numbers are null."""
    one, info = F.get("samples", F.lit(0)), F.col("info")
    number = lambda x, kind: F.when(x != ".", x).try_cast(kind)
    array = lambda x: F.when(x != ".", F.split(x, ",")).cast("array<int>")
    new = {
        "GT": one["GT"], "GQ": number(one["GQ"], "int"), "DP": number(one["DP"], "int"), "PS": number(one["PS"], "long"), "PL": array(one["PL"]), "AD": array(one["AD"]), "info_dp": number(info["DP"], "int"), "STR": F.map_contains_key(info, "STR"), "RU": info["RU"], "RPA": array(info["RPA"]), "ML_PROB": number(info["ML_PROB"], "double"), "DELTA": F.map_contains_key(info, "DELTA"),
        "info": F.map_filter(info, lambda k, _: ~k.isin("DP", "STR", "RU", "RPA", "ML_PROB", "DELTA")), "sample": F.map_filter(one, lambda k, _: ~k.isin("GT", "GQ", "DP", "PS", "PL", "AD")),
    }
    return v.select(*[new.get(c, F.col(c)).cast(t).alias(c) for c, t in _TYPES.items()])


def to_vcf(v: DataFrame) -> DataFrame:
    """Records for ``sources.text.write_vcf`` of a table of calls; what is null is left out, and GT comes first."""
    text = lambda c: F.array_join(c, ",") if c in ("PL", "AD", "RPA", "AC", "AF") else F.col(c).cast("string")
    entry = lambda key, value, there: F.when(there, F.struct(F.lit(key).alias("key"), value.alias("value")))
    fields = [(c, c) for c in ("AC", "AF", "AN") if c in v.columns] + [("DP", "info_dp"), ("RU", "RU"), ("RPA", "RPA"), ("ML_PROB", "ML_PROB")]
    known = [entry(key, text(c), F.col(c).isNotNull()) for key, c in fields] + [entry(c, F.lit(None).cast("string"), F.coalesce(F.col(c), F.lit(False))) for c in ("STR", "DELTA")]
    taken = [key for key, _ in fields] + ["STR", "DELTA"]
    of = lambda entries: F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))
    empty = F.create_map().cast("map<string,string>")
    info = F.map_concat(of(known), F.map_filter(F.coalesce("info", empty), lambda k, _: ~k.isin(*taken)))
    own = ["GT", "GQ", "DP", "PS", "PL", "AD"]
    sample = F.map_concat(of([entry(c, text(c), F.col(c).isNotNull()) for c in own]), F.map_filter(F.coalesce("sample", empty), lambda k, _: ~k.isin(*own)))
    rows = v.select("ctg", "pos", "end", F.when(F.col("id") != ".", F.col("id")).alias("id"), "ref", "alt", "qual", "filter", info.alias("info"), sample.alias("s"))
    return rows.select("ctg", "pos", "end", "id", "ref", "alt", "qual", "filter", "info", F.map_keys("s").alias("format"), F.array("s").alias("samples"))


def _struct(source: Column, **changed: Column) -> Column:
    """A call struct with some fields changed."""
    return F.struct(*[changed.get(c, source[c]).cast(_TYPES[c]).alias(c) for c in _OUT])


def _subset(x: Column, keep: Column, gt: Column, trimmed: Column | None = None) -> Column:
    """A call with only the alleles in ``keep`` (REF first); ``trimmed``: these alleles, if they are known."""
    trimmed = A.subset_alleles(x["ref"], x["alt"], keep) if trimmed is None else trimmed
    n = F.size(x["alt"])
    return _struct(x, ref=trimmed["ref"], alt=trimmed["alts"], end=x["pos"] + F.length(trimmed["ref"]), PL=A.subset_g(x["PL"], keep, n), AD=A.subset_r(x["AD"], keep), RPA=A.subset_r(x["RPA"], keep), GT=gt)


def _haploid_alleles(x: Column) -> Column:
    return F.when(F.size(x["alt"]) > 2, A.two_best_alts(x["PL"], F.size(x["alt"])))


def _diploid_alleles(x: Column) -> Column:
    return F.when(F.size(x["alt"]) != 1, A.diploid_alleles(x["PL"], F.size(x["alt"])))


def trim_haploid(x: Column, keep: Column | None = None, trimmed: Column | None = None) -> Column:
    """A haploid call with the two ALTs of smallest likelihood, if it has more than two. ``keep, trimmed``: see ``_with_kept``."""
    keep = _haploid_alleles(x) if keep is None else keep
    return F.when(F.size(x["alt"]) > 2, _subset(x, keep, A.remap_gt(x["GT"], keep), trimmed)).otherwise(_struct(x))


def trim_diploid(x: Column, keep: Column | None = None, trimmed: Column | None = None) -> Column:
    """A diploid call with the alleles of its best genotypes; null if its likelihoods do not fit. ``keep, trimmed``: see ``_with_kept``."""
    keep = _diploid_alleles(x) if keep is None else keep
    gt = F.when(F.size(keep) == 3, "1/2").otherwise("1/1")
    return F.when(F.size(x["alt"]) == 1, _struct(x)).when(keep.isNotNull(), _subset(x, keep, gt, trimmed))


def _with_kept(rows: DataFrame, alleles, *names: str) -> DataFrame:
    """``rows`` with ``k_x``, the places of the alleles that call x keeps, and ``t_x``, these alleles trimmed: each worked out once for a row."""
    rows = _settled(rows.withColumns({f"k_{c}": alleles(F.col(c)) for c in names}))
    return _settled(rows.withColumns({f"t_{c}": F.when(F.col(f"k_{c}").isNotNull(), A.subset_alleles(F.col(f"{c}.ref"), F.col(f"{c}.alt"), F.col(f"k_{c}"))) for c in names}))


def _kept(c: str) -> tuple[Column, Column, Column]:
    return F.col(c), F.col(f"k_{c}"), F.col(f"t_{c}")


def split_haplotypes(x: Column) -> Column:
    """``array<call>`` of the two haplotypes of a phased (or homozygous) call; null for REF, and for both if the phase is unknown."""
    parts = F.split(x["GT"], r"[/|]")
    known = (x["GT"].contains("|") | (F.get(parts, F.lit(0)) == F.get(parts, F.lit(1)))) & ~x["GT"].contains(".") & (F.size(parts) == 2)

    def one(k):
        i = F.when(known, F.get(parts, F.lit(k)).try_cast("int"))
        return F.when(i > 0, F.get(F.transform(F.array(i), lambda j: _haplotype(x, j)), F.lit(0)))

    return F.array(one(0), one(1))


def _haplotype(x: Column, i: Column) -> Column:
    trimmed = A.subset_alleles(x["ref"], x["alt"], F.array(F.lit(0), i))
    pl = F.when(x["PL"].isNotNull(), F.array(F.get(x["PL"], F.lit(0)), F.get(x["PL"], A.genotype_index(i, i))))
    pl = F.when(F.size(x["PL"]) == F.size(x["alt"]) + 1, F.array(F.get(x["PL"], F.lit(0)), F.get(x["PL"], i))).otherwise(pl)
    two = lambda c: F.when(x[c].isNotNull(), F.array(F.get(x[c], F.lit(0)), F.get(x[c], i)))
    return _struct(x, ref=trimmed["ref"], alt=trimmed["alts"], end=x["pos"] + F.length(trimmed["ref"]), PL=pl, AD=two("AD"), RPA=two("RPA"), GT=F.lit("1"))


def _use(v: Column, d: Column) -> Column:
    """Whether there is a second-pass call and no other, or it explains the other's alleles."""
    return F.coalesce(d["ref"].isNotNull() & (v["ref"].isNull() | A.match_alleles(v["ref"], v["alt"], d["ref"], d["alt"])), F.lit(False))


def _chosen(v: Column, d: Column, use: Column) -> Column:
    """The second-pass call if it is to be used, else the other."""
    return F.when(use, _struct(d)).when(v["ref"].isNotNull(), _struct(v))


def _patched(x: Column, delta: Column) -> Column:
    return _struct(x, DELTA=F.when(delta | x["DELTA"], True), ML_PROB=F.lit(None), filter=F.array().cast("array<string>"))


def _known(x: Column) -> Column:
    """A call, null if it has no genotype."""
    return F.when(x["GT"].isNotNull(), _struct(x))


def _repeat(x: Column) -> Column:
    return F.coalesce(x["STR"] & (F.get(x["RPA"], F.lit(0)) >= 4), F.lit(False))


def _level(frame: DataFrame, row: Column, keep=None) -> DataFrame:
    """The fields of a struct as columns, of rows that ``keep`` holds for.

    A generator stands between two levels of rules, so that conditions on derived calls
    are not pushed through the expressions that derive them. What is derived is derived
    before it: a generator that holds a lambda function is not compiled, with all it holds.
    """
    rows, one = frame.select(row.alias("__row")), F.array("__row")
    return rows.select(F.inline(one if keep is None else F.when(F.coalesce(keep(F.col("__row")), F.lit(False)), one)))


def _settled(frame: DataFrame) -> DataFrame:
    """The same rows, with a generator between what has been derived so far and what is derived from it."""
    return _level(frame, F.struct(*frame.columns))


def _there(x: Column) -> Column:
    return x["ref"].isNotNull()


def _sure(x: Column) -> Column:
    return confident_reference(x["PL"], x["GQ"])


def patch_haploid(v: DataFrame, d: DataFrame) -> DataFrame:
    """Haploid calls with second-pass calls in place of those that they explain. New and repeat calls get DELTA; confident REF calls go."""
    both = joins.cogroup_pos({"v": calls(v), "d": calls(d)})
    both = _level(both, F.struct(F.col("v"), _known(F.col("d")).alias("d")))
    both = _settled(both.withColumn("use", _use(F.col("v"), F.col("d"))))
    rows = _level(both, F.struct(_chosen(F.col("v"), F.col("d"), F.col("use")).alias("x"), "use"), lambda r: _there(r["x"]))
    rows = _with_kept(rows, _haploid_alleles, "x")
    rows = _level(rows, F.struct(trim_haploid(*_kept("x")).alias("x"), "use"), lambda r: ~_sure(r["x"]))
    return _level(rows, _patched(F.col("x"), F.col("use") | _repeat(F.col("x"))))


def patch_haploid_pair(d1: DataFrame, d2: DataFrame, v1: DataFrame | None = None, v2: DataFrame | None = None, phased: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``patch_both_haplotypes`` as one table for each haplotype; where both are read, its one table is worked out once only."""
    both = patch_both_haplotypes(d1, d2, v1, v2, phased)
    return both.where("hap = 1").drop("hap"), both.where("hap = 2").drop("hap")


def patch_both_haplotypes(d1: DataFrame, d2: DataFrame, v1: DataFrame | None = None, v2: DataFrame | None = None, phased: DataFrame | None = None) -> DataFrame:
    """``patch_haploid`` for two haplotypes at once, from two tables or from one phased table that is split first; ``hap`` is 1 or 2.

    A position goes if every haplotype there is a confident REF call. Repeats get DELTA
    only if there are two tables.
    """
    parts = {"d1": calls(d1), "d2": calls(d2)}
    if phased is None:
        both = joins.cogroup_pos({"v1": calls(v1), "v2": calls(v2), **parts})
    else:
        both = joins.cogroup_pos({"p": calls(phased), **parts})
        both = _level(both, F.struct(split_haplotypes(F.col("p")).alias("h"), "d1", "d2")).select(F.get("h", F.lit(0)).alias("v1"), F.get("h", F.lit(1)).alias("v2"), "d1", "d2")
    both = _level(both, F.struct(*[_known(F.col(c)).alias(c) for c in ("v1", "v2", "d1", "d2")]))
    both = _settled(both.withColumns({f"u{k}": _use(F.col(f"v{k}"), F.col(f"d{k}")) for k in (1, 2)}))
    x1, x2 = (_chosen(*(F.col(f"{c}{k}") for c in "vdu")) for k in (1, 2))
    rows = _level(both, F.struct(x1.alias("x1"), "u1", x2.alias("x2"), "u2"), lambda r: _there(r["x1"]) | _there(r["x2"]))
    rows = _with_kept(rows, _haploid_alleles, "x1", "x2")
    trimmed = lambda c: F.when(F.col(f"{c}.ref").isNotNull(), trim_haploid(*_kept(c))).alias(c)
    sure = lambda x: x["ref"].isNull() | _sure(x)
    rows = _level(rows, F.struct(trimmed("x1"), F.col("u1"), trimmed("x2"), F.col("u2")), lambda r: ~(sure(r["x1"]) & sure(r["x2"])))
    halves = rows.select(F.inline(F.array(*[F.struct(F.lit(k).alias("hap"), F.col(f"x{k}").alias("x"), F.col(f"u{k}").alias("use")) for k in (1, 2)]))).where("x.ref is not null")
    delta = F.col("use") | (_repeat(F.col("x")) if phased is None else F.lit(False))
    return halves.select("hap", _patched(F.col("x"), delta).alias("x")).select("hap", "x.*")


def patch_diploid(v: DataFrame, d: DataFrame) -> DataFrame:
    """Diploid calls with second-pass calls in place of those that they explain; new ones get DELTA. Confident REF calls of the second pass go."""
    both = joins.cogroup_pos({"v": calls(v), "d": calls(d)})
    known = F.when(~F.coalesce(F.col("d.GT") == "./.", F.lit(False)), _struct(F.col("d")))
    both = _level(both, F.struct(F.col("v"), known.alias("d")))
    both = _settled(both.withColumn("use", _use(F.col("v"), F.col("d"))))
    rows = _level(both, F.struct(_chosen(F.col("v"), F.col("d"), F.col("use")).alias("x"), "use"), lambda r: _there(r["x"]))
    rows = _with_kept(rows, _diploid_alleles, "x")
    rows = _level(rows, F.struct(trim_diploid(*_kept("x")).alias("x"), "use"), lambda r: _there(r["x"]) & ~(r["use"] & _sure(r["x"])))
    return _level(rows, _patched(F.col("x"), F.col("use")))


def _hap(x: Column) -> Column:
    """Allele of a haploid call: -1 without a call, 0 if it is filtered or REF."""
    gt = F.when(F.size(x["filter"]) > 0, None).otherwise(x["GT"].try_cast("int"))
    return F.when(x["ref"].isNull(), -1).otherwise(F.coalesce(gt, F.lit(0)))


def join_haplotypes(both: DataFrame, numbers: dict[str, str] | None = None) -> DataFrame:
    """Diploid calls from ``ctg, pos, v0 (phased call), v1, v2 (haplotypes), ps (start of the phased interval + 1)``; no row where both are REF.

    INFO begins with the phased call's fields. Of these QD and all with a value for each
    allele go (``numbers``: the header's Number by field; default: the reserved fields);
    counts, frequencies, depth, repeats and ML_PROB are made anew. Samples have GT, GQ, DP,
    PS, PL and AD only.
    """
    return _level(_with_joined(both, numbers), F.col("joined"), lambda r: r["ref"].isNotNull())


def _with_joined(both: DataFrame, numbers: dict[str, str] | None = None) -> DataFrame:
    """``both`` and ``joined``, the diploid call of the haplotypes; null where neither has an ALT."""
    v0, v1, v2 = F.col("v0"), F.col("v1"), F.col("v2")
    rows = both.withColumns({"i1": _hap(v1), "i2": _hap(v2)})
    allele = lambda v, i: F.when(F.col(i) > 0, A.trim_pair(v["ref"], F.get(v["alt"], F.col(i) - 1)))
    rows = _settled(_settled(rows).withColumns({"t1": allele(v1, "i1"), "t2": allele(v2, "i2")}))
    t1, t2 = F.col("t1"), F.col("t2")
    h1, h2 = F.col("i1") > 0, F.col("i2") > 0
    rows = rows.withColumn("same", F.coalesce(h1 & h2 & (t1 == t2), F.lit(False)))
    pair = A.combine_alleles(t1["ref"], t1["alt"], t2["ref"], t2["alt"])
    lone = lambda t: F.struct(t["ref"].alias("ref"), F.array(t["alt"]).alias("alts"))
    rows = rows.withColumn("a", F.when(F.col("same") | ~h2, lone(t1)).when(~h1, lone(t2)).otherwise(pair))
    a, rows = F.col("a"), _settled(rows)
    rows = rows.withColumns({f"m{k}": F.when(v["ref"].isNotNull(), A.allele_map(a["ref"], a["alts"], v["ref"], v["alt"])) for k, v in enumerate((v0, v1, v2))})
    rows = _settled(rows)
    taken = lambda field, m, none: F.when(field.isNotNull(), F.transform(F.col(m), lambda i: F.coalesce(A.at(field, i), F.lit(none))))
    none = F.transform(A.upto(F.size(a["alts"]) + 1), lambda i: F.lit(-1))
    counts = lambda v, h, m: F.when(h & v["RPA"].isNotNull(), F.transform(taken(v["RPA"], m, -1), lambda x: F.when(x == 0, -1).otherwise(x))).otherwise(none)
    flat = F.transform(A.upto(F.size(a["alts"]) + 1), lambda i: F.when(i == 0, 0).otherwise(A.NO_PL))
    likely = lambda v, m: F.coalesce(taken(v["PL"], m, A.NO_PL), flat)
    of_pair = lambda g: F.struct(F.least(F.get("m0", g["i"]), F.get("m0", g["j"])).alias("i"), F.greatest(F.get("m0", g["i"]), F.get("m0", g["j"])).alias("j"))
    whole = F.transform(F.transform(A.genotypes(F.size(a["alts"]) + 1), of_pair), lambda g: F.when(g["i"] < 0, A.NO_PL).otherwise(F.get(v0["PL"], A.genotype_index(g["i"], g["j"]))))
    fill = F.when(v0["PL"].isNotNull(), whole)
    rows = rows.withColumns({"l1": likely(v1, "m1"), "l2": likely(v2, "m2"), "l0": fill, "d0": taken(v0["AD"], "m0", 0), "d1": taken(v1["AD"], "m1", 0), "d2": taken(v2["AD"], "m2", 0), "r1": counts(v1, h1, "m1"), "r2": counts(v2, h2, "m2")})
    rows = _settled(_settled(rows).withColumn("pl", A.join_pl("l1", "l2", "l0")))
    phased = F.col("ps").isNotNull()
    gt = A.join_gt(h1, h2, F.col("same"), phased)
    total0 = F.when(F.col("d0").isNotNull(), F.aggregate("d0", F.lit(0), lambda s, x: s + x))
    depth = F.when(F.col("d1").isNull() & F.col("d2").isNull(), F.col("d0")).otherwise(A.join_ad("d1", "d2", total0))
    ids = [F.when((v["id"] != "."), v["id"]) for v in (v0, v1, v2)]
    prob = F.when(v1["ML_PROB"].isNotNull() & v2["ML_PROB"].isNotNull(), A.join_ml_prob(v1["ML_PROB"], v2["ML_PROB"])).otherwise(F.round(F.coalesce(v1["ML_PROB"], v2["ML_PROB"]), 2))
    first = lambda c: F.when(h1, v1[c]).otherwise(v2[c])
    gone = ["QD", *(k for k, n in (INFO_NUMBERS if numbers is None else numbers).items() if n in ("A", "R"))]
    info = F.map_filter(v0["info"], lambda k, _: ~k.isin(*gone))
    empty = F.create_map().cast("map<string,string>")
    depth_of = lambda c: F.coalesce(A.join_dp(v0[c], v1[c], v2[c]), F.lit(0))
    observed = v0["PL"].isNotNull() | v1["PL"].isNotNull() | v2["PL"].isNotNull()
    new = {
        "ctg": F.col("ctg"), "pos": F.col("pos"), "end": F.col("pos") + F.length(a["ref"]), "id": F.coalesce(*ids, F.lit(".")), "ref": a["ref"], "alt": a["alts"],
        "qual": F.when(h1 & h2, v1["qual"] + v2["qual"]).when(h1, v1["qual"]).otherwise(v2["qual"]), "filter": F.array().cast("array<string>"), "GT": gt["gt"],
        "GQ": F.when(observed, F.col("pl.gq")), "DP": depth_of("DP"), "PS": F.col("ps"), "PL": F.when(observed, F.col("pl.pl")), "AD": depth,
        "info_dp": depth_of("info_dp"), "STR": first("STR"), "RU": first("RU"), "RPA": A.join_rpa("r1", "r2"), "ML_PROB": prob, "DELTA": v0["DELTA"], "info": F.coalesce(info, empty), "sample": empty,
    }
    call = F.struct(*[new[c].cast(_TYPES[c]).alias(c) for c in _OUT], gt["ac"].alias("AC"), gt["af"].alias("AF"), gt["an"].alias("AN"))
    rows = rows.select(*both.columns, F.when(h1 | h2, call).alias("__call"))
    return rows.select(*both.columns, F.explode(F.array("__call")).alias("joined"))


def merge_phased(hap1: DataFrame, hap2: DataFrame, unphased: DataFrame, phased: DataFrame, bed: DataFrame, numbers: dict[str, str] | None = None) -> DataFrame:
    """One call for each position, by priority: a phased call with an ALT as long as REF; else joined haplotypes if one is DELTA; else a DELTA unphased call; else the phased call.

    Filtered and REF calls give none. ``bed``: phased intervals, which set PS. ``numbers``:
    see ``join_haplotypes``. Samples lose PGT and PID, which tell of the phase before.
    """
    # calls move once, to the tasks that hold the intervals of their bin too; of haplotypes no other fields are read
    one, two = (calls(v.drop("info", "sample")) for v in (hap1, hap2))
    both = joins.cogroup_pos({"v1": one, "v2": two, "v3": calls(unphased), "v0": calls(phased)}, width=_WIDTH)
    both = intervals.annotate_point(both, intervals.merge(bed).withColumn("__ps", F.col("start") + 1), {"__ps": "ps"}, _WIDTH, "__bin")
    called = lambda c: F.coalesce(F.col(f"{c}.ref").isNotNull() & (F.size(f"{c}.filter") == 0) & F.col(f"{c}.GT").isNotNull() & (F.col(f"{c}.GT") != "0/0"), F.lit(False))
    equal = called("v0") & F.exists("v0.alt", lambda x: F.length(x) == F.length("v0.ref"))
    delta = lambda c: F.coalesce(F.col(f"{c}.DELTA"), F.lit(False))
    kind = F.when(equal, "phased").when(delta("v1") | delta("v2"), "joined").when(delta("v3"), F.when(called("v3"), "unphased")).when(called("v0"), "phased")
    both = both.withColumn("kind", kind).where("kind is not null")
    # rows of the other kinds have no haplotypes to join, so one pass serves all three
    own = {c: F.when(F.col("kind") == "joined", F.col(c)) for c in ("v1", "v2")}
    rows = _with_joined(both.select("ctg", "pos", "ps", "kind", "v0", "v3", *[c.alias(k) for k, c in own.items()]), numbers)
    extra = [F.lit(None).cast("array<int>").alias("AC"), F.lit(None).cast("array<double>").alias("AF"), F.lit(None).cast("int").alias("AN")]
    plain = lambda x, **changed: F.struct(*[_struct(x, **changed)[c].alias(c) for c in _OUT], *extra)
    ps = F.when(F.col("v0.PS").isNotNull(), F.coalesce("ps", F.col("v0.PS")))
    named = lambda x: F.map_filter(x["sample"], lambda k, _: ~k.isin("PGT", "PID"))
    chosen = F.when(F.col("kind") == "joined", F.col("joined")).when(F.col("kind") == "phased", plain(F.col("v0"), PS=ps, sample=named(F.col("v0")))).otherwise(plain(F.col("v3"), DELTA=F.lit(None), sample=named(F.col("v3"))))
    return _level(rows, chosen, lambda r: r["ref"].isNotNull())


def haploid_and_diploid(diploid: DataFrame, haploid: DataFrame) -> DataFrame:
    """Merged diploid calls and patched haploid calls; of what both have the diploid call stays."""
    return joins.concat_dedup([diploid.select(*_OUT), haploid.select(*_OUT)]).drop("source")


def replace_in_regions(v: DataFrame, second: DataFrame, bed: DataFrame, width: int = intervals.BIN) -> DataFrame:
    """First-pass calls outside of ``bed`` and all second-pass calls."""
    return joins.concat_dedup([intervals.outside_regions(v, bed, width), second]).drop("source")

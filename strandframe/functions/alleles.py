"""Column functions on alleles, genotypes and their likelihoods. Arrays are 0-based here; indices that are absent are -1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Likelihood of what was not observed, and the confidence cap.
NO_PL = 999_999_999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upto(n: Column) -> Column:
    """``[0, n)``; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def at(a: Column, i: Column) -> Column:
    """Element by 0-based index, null outside."""
    return F.when(i >= 0, F.get(a, i.cast("int")))


def common_suffix(r: Column, a: Column, most: Column) -> Column:
    """Length of the longest common suffix of two strings, at most ``most``; found by halving steps."""
    steps = F.when(most > 0, F.transform(F.sequence(F.floor(F.log2(most.cast("double")) + 1e-9).cast("int"), F.lit(0), F.lit(-1)), lambda e: F.call_function("shiftleft", F.lit(1), e))).otherwise(F.array().cast("array<int>"))
    longer = lambda n, s: F.when((n + s <= most) & (F.right(r, n + s) == F.right(a, n + s)), n + s).otherwise(n)
    return F.aggregate(steps, F.lit(0), longer)


def trim_pair(ref: Column | str, alt: Column | str) -> Column:
    """``struct(ref, alt)`` without the common suffix; each keeps one base at least."""
    r, a = _col(ref), _col(alt)
    k = common_suffix(r, a, F.least(F.length(r), F.length(a)) - 1)
    return F.struct(F.substring(r, F.lit(1), F.length(r) - k).alias("ref"), F.substring(a, F.lit(1), F.length(a) - k).alias("alt"))


def match_alleles(ref: Column | str, alts: Column | str, ref2: Column | str, alts2: Column | str) -> Column:
    """Whether every trimmed ALT of the first record is among those of the second."""
    r, r2 = _col(ref), _col(ref2)
    return F.forall(_col(alts), lambda x: F.exists(_col(alts2), lambda y: trim_pair(r, x) == trim_pair(r2, y)))


def allele_map(ref: Column | str, alts: Column | str, ref0: Column | str, alts0: Column | str) -> Column:
    """For each ALT its allele index (from 1) in another record, or -1; REF (0) comes first."""
    r, r0 = _col(ref), _col(ref0)
    other = F.transform(_col(alts0), lambda y: trim_pair(r0, y))
    found = F.transform(_col(alts), lambda x: F.array_position(other, trim_pair(r, x)).cast("int"))
    return F.concat(F.array(F.lit(0)), F.transform(found, lambda k: F.when(k == 0, -1).otherwise(k)))


def combine_alleles(r1: Column | str, a1: Column | str, r2: Column | str, a2: Column | str) -> Column:
    """``struct(ref, alts)`` of two alleles at one position: the longer REF, the other ALT padded with its tail."""
    r1, a1, r2, a2 = map(_col, (r1, a1, r2, a2))
    pad = lambda a, short, long: F.concat(a, F.substring(long, F.length(short) + 1, F.length(long)))
    alts = F.when(F.length(r1) < F.length(r2), F.array(pad(a1, r1, r2), a2)).when(F.length(r1) > F.length(r2), F.array(a1, pad(a2, r2, r1))).otherwise(F.array(a1, a2))
    return F.struct(F.when(F.length(r1) < F.length(r2), r2).otherwise(r1).alias("ref"), alts.alias("alts"))


def genotype_index(i: Column | str, j: Column | str) -> Column:
    """Place of genotype i/j (i <= j) in a likelihood array."""
    i, j = _col(i), _col(j)
    return (j * (j + 1) / 2).cast("int") + i


def genotypes(n: Column | str) -> Column:
    """``struct(i, j)`` of all diploid genotypes of n alleles, in likelihood order."""
    return F.flatten(F.transform(upto(_col(n)), lambda j: F.transform(upto(j + 1), lambda i: F.struct(i.alias("i"), j.alias("j")))))


def gt_alleles(gt: Column | str) -> Column:
    """Alleles of a genotype text as integers, without the missing ones."""
    return F.transform(F.filter(F.split(_col(gt), r"[/|]"), lambda x: (x != ".") & (x != "")), lambda x: x.cast("int"))


def ploidy_of_gt(gt: Column | str) -> Column:
    return F.size(F.split(_col(gt), r"[/|]"))


def allele_count(gt: Column | str) -> Column:
    """Sum of the allele numbers."""
    return F.aggregate(gt_alleles(gt), F.lit(0), lambda s, x: s + x)


def homref_gt(n: Column | str) -> Column:
    return F.array_join(F.array_repeat(F.lit("0"), _col(n).cast("int")), "/")


def gt_or(a: Column | str, b: Column | str) -> Column:
    """Allele by allele OR of two genotypes; where either misses one, ``x/.`` with x of the first known allele of each."""
    one, two = gt_alleles(a), gt_alleles(b)
    n = F.least(F.size(one), F.size(two))
    either = F.array_join(F.zip_with(F.slice(one, 1, n), F.slice(two, 1, n), lambda x, y: x.bitwiseOR(y).cast("string")), "|")
    first = lambda x: F.coalesce(F.get(x, F.lit(0)), F.lit(0))
    return F.when(_col(a).contains(".") | _col(b).contains("."), F.concat(first(one).bitwiseOR(first(two)).cast("string"), F.lit("/."))).otherwise(either)


def second_smallest(pl: Column | str) -> Column:
    return F.get(F.array_sort(_col(pl)), F.lit(1))


def best_genotype(pl: Column | str) -> Column:
    """Index of the smallest likelihood, the first of equals."""
    pl = _col(pl)
    return F.array_position(pl, F.array_min(pl)).cast("int") - 1


def two_best_alts(pl: Column | str, n_alt: Column | str) -> Column:
    """Indices of the alleles to keep of a haploid record: all of at most two ALTs, else the two of smallest PL, the best first (the first two without PL)."""
    pl, n = _col(pl), _col(n_alt)
    ranked = F.array_sort(F.transform(upto(n), lambda i: F.struct(F.get(pl, i + 1).alias("p"), (i + 1).alias("i"))))
    two = F.transform(F.slice(ranked, 1, 2), lambda x: x["i"])
    keep = F.when(n <= 2, F.transform(upto(n), lambda i: i + 1)).when(pl.isNull(), F.array(F.lit(1), F.lit(2))).otherwise(two)
    return F.concat(F.array(F.lit(0)), keep)


def diploid_alleles(pl: Column | str, n_alt: Column | str) -> Column:
    """Alleles to keep of a diploid record, REF included: those of its best genotype with an ALT.

    If that genotype has one ALT only, also those of the best other genotype that holds
    REF or this ALT. Null if the likelihoods do not fit the number of alleles.
    """
    pl, n = _col(pl), _col(n_alt)
    ranked = F.zip_with(genotypes(n + 1), pl, lambda g, p: F.struct(p.alias("p"), g["j"].alias("j"), g["i"].alias("i")))
    ranked = F.filter(ranked, lambda g: g["j"] > 0)

    def kept(first):
        one = (first["i"] == 0) | (first["i"] == first["j"])
        other = F.filter(ranked, lambda g: ~((g["i"] == first["i"]) & (g["j"] == first["j"])) & (g["i"].isin(0) | g["j"].isin(0) | (g["i"] == first["j"]) | (g["j"] == first["j"])))
        second = F.array_min(other)
        return F.when(one, F.array(F.lit(0), second["i"], first["j"], second["j"])).otherwise(F.array(F.lit(0), first["i"], first["j"]))

    chosen = F.transform(F.array(F.array_min(ranked)), kept)
    return F.when(F.size(pl) == ((n + 1) * (n + 2) / 2).cast("int"), F.array_sort(F.array_distinct(F.filter(F.get(chosen, F.lit(0)), lambda x: x.isNotNull()))))


def subset_r(values: Column | str, keep: Column) -> Column:
    """Elements of an array with one entry for each allele (REF first)."""
    values = _col(values)
    return F.when(values.isNotNull(), F.transform(keep, lambda i: F.get(values, i)))


def subset_a(values: Column | str, keep: Column) -> Column:
    """Elements of an array with one entry for each ALT; ``keep`` holds allele numbers."""
    values = _col(values)
    return F.when(values.isNotNull(), F.transform(F.filter(keep, lambda i: i > 0), lambda i: F.get(values, i - 1)))


def subset_g(values: Column | str, keep: Column, n_alt: Column | str) -> Column:
    """Elements of a genotype array: haploid layout if it has one entry for each allele, else the diploid triangle."""
    values = _col(values)
    pairs = F.transform(genotypes(F.size(keep)), lambda g: F.get(values, genotype_index(F.get(keep, g["i"]), F.get(keep, g["j"]))))
    return F.when(F.size(values) == _col(n_alt) + 1, subset_r(values, keep)).otherwise(F.when(values.isNotNull(), pairs))


def subset_fields(values: Column | str, numbers: dict[str, str], keep: Column, n_alt: Column | str) -> Column:
    """A map of fields as texts, those of Number A, R and G cut to the alleles in ``keep`` (REF first).

    ``numbers``: the header's Number by field. Fields of another Number, flags and ``.``
    stay. A genotype field has one value for each allele (haploid) or each diploid
    genotype; any other size is an error. Other fields may be short: what is not there
    is left out.
    """
    n = _col(n_alt)
    named = {x: [k for k, number in numbers.items() if number == x] for x in "ARG"}

    def cut(key, value, parts):
        whole = (F.size(parts) == n + 1) | (F.size(parts) == ((n + 1) * (n + 2) / 2).cast("int"))
        genotype = F.when(whole, subset_g(parts, keep, n)).otherwise(F.raise_error(F.concat(F.lit("a genotype field of the wrong size: "), key, F.lit("="), value)).cast("array<string>"))
        out = None
        for x, kept in (("A", subset_a(parts, keep)), ("R", subset_r(parts, keep)), ("G", genotype)):
            if named[x]:
                out = (F.when if out is None else out.when)(key.isin(*named[x]), F.array_join(kept, ","))
        return out

    def rule(key, value):
        # the lambda function splits a value once, not for each element that is taken of it
        split = F.transform(F.array(F.split(value, ",")), lambda parts: cut(key, value, parts))
        mine = key.isin(*(k for x in "ARG" for k in named[x]))
        return F.when(value.isNull() | (value == ".") | ~mine, value).otherwise(F.get(split, F.lit(0)))

    return F.transform_values(_col(values), rule) if any(named.values()) else _col(values)


def subset_alleles(ref: Column | str, alts: Column | str, keep: Column) -> Column:
    """``struct(ref, alts)`` of the kept ALTs, without the suffix that all of them share; each keeps one base."""
    r, kept = _col(ref), F.transform(F.filter(keep, lambda i: i > 0), lambda i: F.get(_col(alts), i - 1))
    shortest = F.aggregate(kept, F.length(r), lambda n, a: F.least(n, F.length(a)))
    k = F.aggregate(kept, shortest - 1, lambda n, a: common_suffix(r, a, n))
    return F.struct(F.substring(r, F.lit(1), F.length(r) - k).alias("ref"), F.transform(kept, lambda a: F.substring(a, F.lit(1), F.length(a) - k)).alias("alts"))


def remap_gt(gt: Column | str, keep: Column, sep: str = "/") -> Column:
    """A genotype with its alleles renumbered after ``keep``; others become 0."""
    place = lambda x: F.greatest(F.array_position(keep, x).cast("int") - 1, F.lit(0))
    return F.array_join(F.transform(gt_alleles(gt), lambda x: place(x).cast("string")), sep)


def best_pl(pl: Column | str, index: Column | None = None) -> Column:
    """``struct(allele, pl)``: (0, PL[0]) without an index, else (index, its PL); (-1, NO_PL) for an allele that is not there; (0, 0) for a missing record."""
    pl = _col(pl)
    none = F.struct(F.lit(-1).alias("allele"), F.lit(NO_PL).alias("pl"))
    if index is None:
        return F.struct(F.lit(0).alias("allele"), F.when(pl.isNull(), F.lit(0)).otherwise(F.get(pl, F.lit(0))).cast("int").alias("pl"))
    return F.when((index < 0) | pl.isNull(), none).otherwise(F.struct(index.cast("int").alias("allele"), F.get(pl, index).cast("int").alias("pl")))


def join_pl(d1: Column | str, d2: Column | str, fill: Column | str | None = None) -> Column:
    """``struct(pl, gq)``: diploid likelihoods of two haploid arrays over the same alleles.

    PL(i, j) is the smaller of d1[i] + d2[j] and d1[j] + d2[i]; what was not observed
    comes from ``fill``, an array in the same order, if it is given. The smallest becomes
    0 and GQ is the second smallest; values are capped at the larger of their range with
    GQ added and ten times GQ, and what stays unobserved has that value.
    """
    d1, d2 = _col(d1).cast("array<long>"), _col(d2).cast("array<long>")
    pair = lambda x, y: F.when((x >= NO_PL) | (y >= NO_PL), F.lit(NO_PL).cast("long")).otherwise(x + y)
    raw = F.transform(genotypes(F.size(d1)), lambda g: F.least(pair(F.get(d1, g["i"]), F.get(d2, g["j"])), pair(F.get(d1, g["j"]), F.get(d2, g["i"]))))
    if fill is not None:
        raw = F.when(_col(fill).isNull(), raw).otherwise(F.zip_with(raw, _col(fill).cast("array<long>"), lambda e, f: F.when(e < NO_PL, e).otherwise(F.coalesce(f, e))))

    def finished(raw):
        seen = F.array_sort(F.filter(raw, lambda x: x < NO_PL))
        low = F.get(seen, F.lit(0))
        gq = F.get(seen, F.lit(1)) - low
        cap = F.greatest(F.array_max(seen) - low + gq, 10 * gq)
        return F.struct(F.transform(raw, lambda x: F.least(x - low, cap).cast("int")).alias("pl"), gq.cast("int").alias("gq"))

    return F.get(F.transform(F.array(raw), finished), F.lit(0))


def join_ad(a1: Column | str, a2: Column | str, total0: Column | str | None = None) -> Column:
    """Allele depths of two haplotypes: their sum; of one alone, REF raised to what the whole record's depth leaves."""
    a1, a2 = _col(a1), _col(a2)
    both = F.zip_with(a1, a2, lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    one = F.coalesce(a1, a2)
    if total0 is None:
        return F.when(a1.isNotNull() & a2.isNotNull(), both).otherwise(one)
    alts = F.aggregate(F.slice(one, 2, F.greatest(F.size(one) - 1, F.lit(0))), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)).cast("int"))
    raised = F.concat(F.array(F.greatest(F.get(one, F.lit(0)), F.coalesce(_col(total0), F.lit(0)) - alts)), F.slice(one, 2, F.greatest(F.size(one) - 1, F.lit(0))))
    return F.when(a1.isNotNull() & a2.isNotNull(), both).otherwise(raised)


def join_rpa(a: Column | str, b: Column | str) -> Column:
    """Repeat counts: the larger of each pair, kept only if all are over 0."""
    top = F.zip_with(_col(a), _col(b), lambda x, y: F.greatest(x, y))
    return F.when(F.array_min(F.transform(top, lambda x: F.coalesce(x, F.lit(0)))) > 0, top)


def join_str_ru(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(_col(a), _col(b))


def join_dp(whole: Column | str, a: Column | str, b: Column | str) -> Column:
    """The whole record's depth, else the sum of the haplotypes'."""
    a, b = _col(a), _col(b)
    return F.coalesce(_col(whole), F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))))


def join_ml_prob(a: Column | str, b: Column | str) -> Column:
    return F.round(_col(a) * _col(b), 2)


def join_gt(hap1: Column | str, hap2: Column | str, same: Column | str, phased: Column | str) -> Column:
    """``struct(gt, ac, af, an)`` of two haplotypes: whether each has an ALT, whether it is the same one, and whether they are phased."""
    h1, h2, same, phased = map(_col, (hap1, hap2, same, phased))
    sep = F.when(phased, "|").otherwise("/")
    ints = lambda *x: F.array(*map(F.lit, x))
    two = h1 & h2
    gt = F.when(two & same, F.concat(F.lit("1"), sep, F.lit("1"))).when(two, F.concat(F.lit("1"), sep, F.lit("2"))).when(phased & h1, "1|0").when(phased, "0|1").otherwise("0/1")
    ac = F.when(two & same, ints(2)).when(two, ints(1, 1)).otherwise(ints(1))
    af = F.when(two & same, ints(1.0)).when(two, ints(0.5, 0.5)).otherwise(ints(0.5))
    return F.struct(gt.alias("gt"), ac.alias("ac"), af.alias("af"), F.lit(2).alias("an"))


def add_nonref_pl(pl: Column | str, n_alleles: Column | str, ploidy: Column | str, compat: bool = False) -> Column:
    """Likelihoods with one more ALT, 100 for each genotype that has it.

    The new genotypes come last in index order; ``compat`` places them in the order in
    which genotypes are listed by their first allele.
    """
    pl, n = _col(pl), _col(n_alleles)
    haploid = F.concat(pl, F.array(F.lit(100)))
    tail = F.concat(pl, F.array_repeat(F.lit(100), (n + 1).cast("int")))
    if compat:
        k = F.array_sort(F.transform(genotypes(n + 1), lambda g: F.struct(g["i"].alias("i"), g["j"].alias("j"))))
        old = lambda g: F.aggregate(k, F.lit(0), lambda s, h: s + F.when((h["j"] < n) & (h < g), 1).otherwise(0))
        tail = F.transform(k, lambda g: F.when(g["j"] == n, F.lit(100)).otherwise(F.get(pl, old(g))))
    return F.when(_col(ploidy) == 1, haploid).otherwise(tail)


def add_nonref_ad(ad: Column | str, dp: Column | str) -> Column:
    """Depths with one more allele that takes what is left of the total depth, 0 at least."""
    ad = _col(ad)
    rest = F.coalesce(_col(dp), F.lit(0)) - F.aggregate(ad, F.lit(0), lambda s, x: s + x.cast("int"))
    return F.concat(ad, F.array(F.greatest(rest, F.lit(0)).cast("int")))


def added_alts(alts: Column | str, af: Column | str) -> Column:
    """Allele numbers that the caller knows: REF, the ALTs up to ``<NON_REF>``, or without it those with a frequency."""
    alts, af = _col(alts), _col(af)
    end = F.array_position(alts, "<NON_REF>").cast("int")
    known = F.when(end > 0, F.transform(upto(end), lambda i: i + 1)).otherwise(F.filter(F.transform(upto(F.size(alts)), lambda i: i + 1), lambda i: F.coalesce(F.get(af, i - 1), F.lit(".")) != "."))
    return F.concat(F.array(F.lit(0)), known)


def str_end(pos: Column | str, unit: Column | str, repeats: Column | str) -> Column:
    """End of a short tandem repeat: one base and the units of the reference."""
    return _col(pos) + 1 + F.length(_col(unit)) * F.get(_col(repeats), F.lit(0))


def copy_number(difference: Column | str, neutral: int = 2) -> Column:
    return F.lit(neutral) + _col(difference)


def edge_distance(pos: Column | str, start: Column | str, stop: Column | str) -> Column:
    """Distance from a position to a range, 0 inside."""
    return F.greatest(_col(start) - _col(pos), _col(pos) - _col(stop), F.lit(0))


def parse_info(text: Column | str) -> Column:
    """``k=v;flag`` as a map; a flag's value is null, ``.`` the empty map."""
    text = _col(text)
    return F.when(text == ".", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).otherwise(F.str_to_map(text, F.lit(";"), F.lit("=")))


def parse_header(line: Column | str) -> Column:
    """``##X=<k=v,k="a, b">`` as a map, quotes taken off."""
    line = _col(line)
    keys = F.regexp_extract_all(line, F.lit(r'[<,]([A-Za-z0-9_.]+)=("[^"]*"|[^,>]*)'), F.lit(1))
    values = F.regexp_extract_all(line, F.lit(r'[<,]([A-Za-z0-9_.]+)=("[^"]*"|[^,>]*)'), F.lit(2))
    return F.map_from_arrays(keys, F.transform(values, lambda v: F.regexp_replace(v, '^"|"$', "")))


def parse_rg(line: Column | str) -> Column:
    """A read group line as a map; tabs may be written ``\\t``; a field without a colon is an error."""
    fields = F.filter(F.split(F.regexp_replace(_col(line), r"\\t", "\t"), "\t"), lambda x: x != "@RG")
    broken = F.exists(fields, lambda x: ~x.contains(":"))
    return F.when(broken, F.raise_error(F.lit("a read group field without a colon")).cast("map<string,string>")).otherwise(F.str_to_map(F.array_join(fields, "\t"), F.lit("\t"), F.lit(":")))

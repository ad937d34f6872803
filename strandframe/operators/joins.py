"""Joins of call sets by position, allele and similarity."""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import alleles as A
from . import intervals
from .normalise import _stored


def first_per_pos(v: DataFrame, order: str = "file_order", keys: tuple[str, ...] = ("ctg", "pos")) -> DataFrame:
    """The first row of each position, rows without an order last; a partial aggregate, so a crowded position is no large group."""
    row = F.struct(*[c for c in v.columns if c not in keys])
    return v.groupBy(*keys).agg(F.min_by(row, F.struct(F.col(order).isNull(), order)).alias("__row")).select(*keys, "__row.*")


def cogroup_pos(parts: dict[str, DataFrame], order: str = "file_order", width: int | None = None) -> DataFrame:
    """``(ctg, pos)`` and one struct column for each input, null where it has no row; repeats at a position are dropped first.

    All inputs are dealt to tasks at once, by position, or with ``width`` by bins of that
    many bases, whose number is the further column ``__bin``: what meets them by ``ctg``
    and ``__bin`` next does not move them again. Rows without a contig or a position meet
    none of another input.
    """
    own = lambda v: F.struct(F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("order")).alias("o"), F.struct(*[F.col(c) for c in v.columns]).alias("v"))
    kinds = {name: v.select(own(v).alias("x")).schema["x"].dataType for name, v in parts.items()}
    lone = F.col("ctg").isNull() | F.col("pos").isNull()
    tagged = [v.select("ctg", "pos", F.when(lone, F.lit(k)).alias("__lone"), *[(own(v) if name == c else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()]) for k, (name, v) in enumerate(parts.items())]
    both = reduce(DataFrame.union, tagged)
    by = ["ctg", "pos"]
    if width:
        by, both = ["ctg", "__bin"], both.withColumn("__bin", intervals.bin_of("pos", width))
    found = both.repartition(*by).groupBy(*dict.fromkeys([*by, "pos", "__lone"])).agg(*[F.min_by(f"{c}.v", f"{c}.o").alias(c) for c in kinds])
    return found.select("ctg", "pos", *(["__bin"] if width else []), *kinds)


def lost_rows(v: DataFrame) -> DataFrame:
    """How many rows ``first_per_pos`` drops."""
    return v.groupBy("ctg", "pos").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("lost"))


def concat_dedup(parts: list[DataFrame], keys: tuple[str, ...] = ("ctg", "pos", "ref", "alt"), source: str = "source") -> DataFrame:
    """Union with the number of the input; of keys in several inputs the rows of the first one stay, repeats within it too."""
    both = reduce(DataFrame.unionByName, [p.withColumn(source, F.lit(k)) for k, p in enumerate(parts)])
    first = both.groupBy(*keys).agg(F.min(source).alias("__first")).select(*[F.col(k).alias(f"__{k}") for k in keys], "__first")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return both.join(first, on & (F.col(source) == F.col("__first")), "left_semi")


def source_union(parts: dict[str, DataFrame], name: str = "SOURCE") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn(name, F.lit(k)) for k, p in parts.items()])


def header_union(a: DataFrame, b: DataFrame, remove: DataFrame | None = None) -> DataFrame:
    """Header lines ``(kind, id, ...)`` of ``a``, and those of ``b`` whose id it lacks; ``remove`` takes lines out."""
    both = a.unionByName(b.join(a.select("kind", "id"), ["kind", "id"], "left_anti"))
    return both if remove is None else both.join(remove.select("kind", "id"), ["kind", "id"], "left_anti")


def by_allele(v: DataFrame) -> DataFrame:
    """One row for each ALT, trimmed: ``tref, talt, allele`` (from 1) beside the row's own columns."""
    rows = v.select("*", F.posexplode("alt").alias("__i", "__a"))
    t = A.trim_pair("ref", "__a")
    return rows.withColumns({"tref": t["ref"], "talt": t["alt"], "allele": F.col("__i") + 1}).drop("__i", "__a")


def transfer_annotations(raw: DataFrame, pop: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """``raw`` (unique ``key``) and, for each rule ``{field: sum | max | min | avg}``, an array with a value for each of its ALTs.

    ``pop`` has one array for each field, aligned with its ALTs. Alleles meet trimmed;
    alleles and contigs that ``pop`` lacks get null.
    """
    how = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}
    values = by_allele(pop).select("ctg", "pos", "tref", "talt", *[F.get(F.col(f), F.col("allele") - 1).alias(f"__p_{f}") for f in rules])
    values = values.groupBy("ctg", "pos", "tref", "talt").agg(*[how[r](f"__p_{f}").alias(f"__p_{f}") for f, r in rules.items()])
    own = by_allele(raw).select(key, "ctg", "pos", "tref", "talt", "allele").join(values, ["ctg", "pos", "tref", "talt"], "left")
    lists = own.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("allele", *[f"__p_{f}" for f in rules]))).alias("__l"))
    return raw.join(lists, key, "left").withColumns({f"pop_{f}": F.col(f"__l.__p_{f}") for f in rules}).drop("__l")


def annotate_ids(v: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``v`` (unique ``key``) and ``known_id``, the smallest id of a known variant with one of its alleles."""
    ids = by_allele(known).groupBy("ctg", "pos", "tref", "talt").agg(F.min("id").alias("known_id"))
    hit = by_allele(v).select(key, "ctg", "pos", "tref", "talt").join(ids, ["ctg", "pos", "tref", "talt"]).groupBy(key).agg(F.min("known_id").alias("known_id"))
    return v.join(hit, key, "left")


def check_contigs(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Contigs of ``expected (ctg, length)`` that ``found`` lacks or has with another length."""
    return expected.select("ctg", "length").join(found.select("ctg", "length"), ["ctg", "length"], "left_anti")


def validate_one_sample(groups: DataFrame, sample: str | None = None, strict: bool = False) -> DataFrame:
    """One row ``(samples, missing, valid)`` of read groups ``(rg, tags map)``: none lacks SM, and all share one unless ``sample`` overrides them.

    ``strict``: reading the row of groups that are not valid is an error.
    """
    found = groups.select(F.col("tags")["SM"].alias("sm")).agg(F.countDistinct("sm").alias("samples"), F.count_if(F.col("sm").isNull()).alias("missing"))
    valid = (F.col("missing") == 0) & ((F.col("samples") == 1) | F.lit(sample is not None))
    checked = F.when(valid, F.lit(True)).otherwise(F.raise_error(F.lit("read groups without a sample, or of several")).cast("boolean")) if strict else valid
    return found.withColumn("valid", checked)


#: Letters after which a common subsequence asks whether it can still reach its threshold.
_BLOCK = 1024


def _lcs(a: str, b: str, least: int = 0) -> int:
    """Length of the longest common subsequence, the rows of the table as bits of one integer; 0 if it is under ``least``.

    The recurrence is that of H. Hyyro, "Bit-parallel LCS-length computation revisited" (2004).
    With ``least`` only the band is worked out in which a subsequence of that length lies
    (it leaves out at most so many letters of either text), and the rest is given up as
    soon as all further letters would not do.
    """
    if len(a) < len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for c in set(a):
        at[c] = int("".join("1" if x == c else "0" for x in reversed(a)), 2)
    n = len(a)
    full = row = (1 << n) - 1
    # a letter of b at i meets letters of a from i - skip_b to i + skip_a
    skip_a, skip_b = (n - least, len(b) - least) if least else (n, n)
    for begin in range(0, len(b), _BLOCK):
        block = b[begin : begin + _BLOCK]
        low, high = max(0, begin - skip_b), min(n, begin + len(block) + skip_a)
        full = (1 << (high - low)) - 1
        own = {c: at[c] >> low & full for c in set(block) if c in at}
        window = row >> low & full
        for c in block:
            match = window & own.get(c, 0)
            window = ((window + match) | (window - match)) & full
        row = (row >> high << high) | (window << low) | (row & ((1 << low) - 1))
        if least and n - row.bit_count() + len(b) - begin - len(block) < least:
            return 0
    found = n - row.bit_count()
    return found if found >= least else 0


def similarity(a: str | None, b: str | None, threshold: float = 0.0) -> float | None:
    """Twice the common subsequence over both lengths; 1 for two empty texts, null for a null. Under a threshold it may be 0 instead."""
    if a is None or b is None:
        return None
    if a == b:
        return 1.0
    total = len(a) + len(b)
    least = math.ceil(threshold * total / 2 - 1e-9)
    if min(len(a), len(b)) < max(1, least):
        return 0.0
    if least and sum(min(a.count(c), b.count(c)) for c in set(a)) < least:
        return 0.0
    return 2 * _lcs(a, b, least) / total


#: Pairs that are worked out side by side, words of 64 letters that the shorter text of such a pair has at most, and different letters of all.
_SIDE, _WORDS, _LETTERS = 2048, 4, 128


def _lcs_side_by_side(a: list[str], b: list[str]) -> np.ndarray:
    """``_lcs`` of pairs of which ``a`` is the shorter text: a step takes one letter of each ``b``."""
    n, la, lb = len(a), np.array([*map(len, a)]), np.array([*map(len, b)])
    kind, size = ("S", np.uint8) if all(map(str.isascii, a)) and all(map(str.isascii, b)) else ("<U", np.uint32)
    codes = lambda x: np.array(x, dtype=f"{kind}{max(map(len, x))}").view(size).reshape(n, -1)
    ca, cb = codes(a), codes(b)
    letters = np.flatnonzero(np.bincount(ca.reshape(-1)))
    if len(letters) > _LETTERS:
        return np.array([_lcs(x, y) for x, y in zip(a, b)])
    # what no letter of a equals, and the places beyond the end of b, have no bits
    number = np.full(int(max(ca.max(), cb.max())) + 1, len(letters), np.int16)
    number[letters] = np.arange(len(letters))
    ib = number[cb]
    ib[np.arange(cb.shape[1]) >= lb[:, None]] = len(letters)
    words = -(-ca.shape[1] // 64)
    ca = np.pad(ca, ((0, 0), (0, 64 * words - ca.shape[1])))
    there = np.arange(64 * words) < la[:, None]
    of_letter = [np.packbits((ca == c) & there, axis=1, bitorder="little").view("<u8").T for c in letters]
    bits = np.concatenate([*of_letter, np.zeros((words, n), np.uint64)]).reshape(-1)
    at = ib.T.astype(np.int64, order="C") * (words * n) + np.arange(n)
    row = np.full((words, n), np.iinfo(np.uint64).max)
    for place in at:
        carry = None
        for w in range(words):
            match = row[w] & bits.take(place + w * n if w else place)
            added = row[w] + match
            if w < words - 1:
                over = added < match
            if carry is not None:
                added += carry
                if w < words - 1:
                    over |= added < carry
            row[w] = added | (row[w] ^ match)
            carry = over.astype(np.uint64) if w < words - 1 else None
    return 64 * words - np.bitwise_count(row).sum(axis=0, dtype=np.int64)


def _similarities(a: list, b: list, threshold: float) -> np.ndarray:
    """``similarity`` of pairs; short texts side by side, in the order of their lengths."""
    found = np.full(len(a), np.nan)
    short = []
    for i, (x, y) in enumerate(zip(a, b)):
        if x is not None and y is not None:
            if x == y:
                found[i] = 1.0
            elif 0 < min(len(x), len(y)) <= 64 * _WORDS:
                short.append((len(x) + len(y), max(len(x), len(y)), i))
            else:
                found[i] = similarity(x, y, threshold)
    short.sort()
    for at in range(0, len(short), _SIDE):
        total, _, own = map(np.array, zip(*short[at : at + _SIDE]))
        pairs = [(a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i]) for i in own]
        lcs = _lcs_side_by_side(*map(list, zip(*pairs)))
        found[own] = np.where(lcs >= np.ceil(threshold * total / 2 - 1e-9), 2 * lcs / total, 0.0)
    return found


@lru_cache
def _similarity(threshold: float):
    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_similarities(a.tolist(), b.tolist(), threshold), dtype="float64")

    return F.pandas_udf(ratios, T.DoubleType())


def lcs_ratio(a: Column | str, b: Column | str, threshold: float = 0.0) -> Column:
    """``similarity`` of two columns: with a threshold, the ratio where it reaches it and 0 where it does not.

    Bounds by length and by the counts of letters come first, then a common subsequence
    that works on the band in which the threshold can be reached, and stops when it can't.
    """
    return _similarity(threshold)(a, b)


def ratio_bound(a: Column | str, b: Column | str, letters: str = "ACGT") -> Column:
    """An upper bound of ``lcs_ratio`` from the lengths and the counts of ``letters``."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    count = lambda s, c: F.length(s) - F.length(F.replace(s, F.lit(c), F.lit("")))
    shared = reduce(lambda x, y: x + y, [F.least(count(a, c), count(b, c)) for c in letters])
    other = lambda s: F.length(F.translate(s, letters, ""))
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * (shared + F.least(other(a), other(b))) / total)


#: Words of 64 bits in which a string's tokens are marked.
MARKS = 4


def _prefixes(strings: DataFrame, threshold: float, shared: int) -> DataFrame:
    """``(seq, n, rare array, m0 ...)``: the tokens of a string, rarest first, that a partner must share ``shared`` of; and all its tokens as marks.

    A token is a letter and how often it has come so far, so two strings have as many
    common tokens as their common subsequence has letters at least. A partner of a string
    of n letters has ``o = ceil(threshold * n / (2 - threshold))`` of them at least, and of
    o common tokens the first ``shared`` lie among the first ``n - o + shared`` of both.
    As many tokens that all strings have come last, for strings with fewer letters. Marks
    are bits that tokens set or clear: of two strings no more differ than tokens do.
    """
    letters = strings.select("seq", F.explode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("c")).groupBy("seq", "c").agg(F.count("*").alias("k"))
    tokens = letters.select("seq", F.explode(F.transform(F.sequence(F.lit(1).cast("long"), "k"), lambda i: F.xxhash64("c", i))).alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("often"))
    word, bit = F.pmod("token", F.lit(MARKS)), F.expr(f"shiftleft(1L, cast(pmod(token div {MARKS}, 64) as int))")
    marks = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"m{k}") for k in range(MARKS)]
    ranked = tokens.join(often, "token").groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("t"), *marks)
    kept = [F.coalesce(f"m{k}", F.lit(0).cast("long")).alias(f"m{k}") for k in range(MARKS)]
    rows = strings.join(ranked, "seq", "left").select("seq", F.length("seq").alias("n"), F.coalesce(F.transform("t", lambda x: x["token"]), F.array().cast("array<bigint>")).alias("t"), *kept)
    need = F.ceil(F.lit(threshold) * F.col("n") / F.lit(2 - threshold) - 1e-9)
    pads = F.array(*[F.lit(-1 - k).cast("bigint") for k in range(shared)])
    return rows.select("seq", "n", F.slice(F.concat("t", pads), F.lit(1), (F.col("n") - need + shared).cast("int")).alias("rare"), *[f"m{k}" for k in range(MARKS)])


def _combinations(items: Column, size: int) -> Column:
    """Hashes of all combinations of ``size`` elements in order."""

    def upto(last: Column, left: int, so_far: Column) -> Column:
        if left == 0:
            return F.array(so_far)
        places = A.upto(last)
        return F.flatten(F.transform(places, lambda i: upto(i, left - 1, F.xxhash64(so_far, F.get(items, i)))))

    return upto(F.size(items), size, F.lit(0).cast("bigint"))


#: Lengths of a class of long strings differ by less than this factor.
_CLASS = 1.05
#: Letters at an end of a string that are compared before the strings are, by two bits of each; strings of one segment that are tried against one task's.
_END, _CELL = 32, 4096


def _by_tokens(n: int, threshold: float, shared: int) -> bool:
    """Whether a string of n letters has no more combinations of rare tokens than eight for each letter."""
    prefix = n - math.ceil(threshold * n / (2 - threshold) - 1e-9) + shared
    return math.comb(prefix, shared) <= 8 * n


def _packed_ends(seq: pd.Series) -> pd.DataFrame:
    """The first and the last ``_END`` letters, two bits of each, from the end inwards; of shorter strings all."""

    def pack(ends: list[str]) -> np.ndarray:
        codes = np.array([x.ljust(_END, "\0") for x in ends], f"<U{_END}").view(np.uint32).reshape(-1, _END)
        two = (codes >> 1 & 3).astype(np.uint64) << np.arange(0, 2 * _END, 2, dtype=np.uint64)
        return np.bitwise_or.reduce(two, axis=1).view(np.int64)

    # trailing zeros of a text are not kept by numpy, and stand for the same bits
    return pd.DataFrame({"first": pack([x[:_END] for x in seq]), "last": pack([x[: -_END - 1 : -1] for x in seq])})


#: One bit of each letter of a packed end.
_ONES = np.uint64(0x5555555555555555)


def _equal_letters(ends: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """A bit for each letter of packed ends that equals ``letter`` (0 to 3)."""
    same = ~(ends ^ (letter * _ONES))
    return same & (same >> np.uint64(1)) & _ONES


def _ends_lcs(a: np.ndarray, b: np.ndarray, steps: int) -> np.ndarray:
    """Common subsequence of the packed ends ``a`` and the first ``steps`` letters of the ends ``b``, at least; ``b`` may be one end.

    The recurrence is that of ``_lcs``, with a set bit between two letters that hands the carry on.
    """
    row = np.full(len(a), np.iinfo(np.uint64).max)
    one = b.ndim == 0
    of_letter = [_equal_letters(a, np.uint64(c)) for c in range(4)] if one else []
    for k in range(steps):
        letter = b >> np.uint64(2 * k) & np.uint64(3)
        match = row & (of_letter[int(letter)] if one else _equal_letters(a, letter))
        row = (row + match) | (row ^ match)
    return _END - np.bitwise_count(row & _ONES).astype(np.int64)


def _ends_agree(n: np.ndarray, end: np.ndarray, n_b: np.ndarray, end_b: np.ndarray, threshold: float) -> np.ndarray:
    """Which strings of ``n`` letters can have the ratio with strings of ``n_b``, as long or longer, by their lengths and packed ends; ``n_b, end_b`` may be one string's.

    With x letters left out of the shorter string and y of the longer one, the last k
    letters of the longer one have ``k - y`` in common with the last ``k + x`` of the other.
    """
    least = np.ceil(threshold * (n + n_b) / 2 - 1e-9).astype(np.int64)
    out, out_b = n - least, n_b - least
    agree = out >= 0
    steps = np.minimum(_END - out, np.minimum(n, n_b))
    tried = np.flatnonzero(agree & (steps > out_b))
    if len(tried):
        k = int(steps[tried].min())
        common = _ends_lcs(end[tried], end_b[tried] if end_b.ndim else end_b, k)
        agree[tried] = common >= k - out_b[tried]
    return agree


#: Pairs that are compared at once.
_AT_ONCE = 1 << 18


def _pairs_of_keys(threshold: float, kind: str):
    """For ``mapInArrow``: pairs ``(id, id_b)`` whose ends agree, of rows ``(key, cell, long, id, n, end)`` in the order of the first three.

    Rows with ``long`` are tried against those without it of the same key and cell, of
    which there are few enough to be held.
    """

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            key, cell, long, n, end = (table.column(c).to_numpy() for c in ("key", "cell", "long", "n", "end"))
            ids, end = table.column("id").to_numpy(), end.view(np.uint64)
            n, rows = n.astype(np.int64), len(key)
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
            stop = np.r_[new[1:], rows]
            shorts = np.add.reduceat((~long).astype(np.int64), new)
            split = new + shorts
            held = table.slice(int(new[-1]), int(shorts[-1])) if shorts[-1] else None
            found = []

            def keep(a, b):
                first = (n[a] < n[b]) | ((n[a] == n[b]) & (ids[a] < ids[b]))
                a, b = a[first], b[first] if b.ndim else b
                agree = _ends_agree(n[a], end[a], n[b], end[b], threshold)
                found.append((a[agree], np.broadcast_to(b, len(a))[agree]))

            many = shorts >= 512
            for g in np.flatnonzero(many):
                own = np.arange(new[g], split[g])
                for b in range(split[g], stop[g]):
                    keep(own, np.array(b))
            few = np.flatnonzero(~many & (shorts > 0) & (stop > split))
            # the rows with ``long`` of these groups, each repeated for the rows it is tried against
            longs = np.concatenate([np.arange(split[g], stop[g]) for g in few]) if len(few) else np.empty(0, np.int64)
            group = np.repeat(few, (stop - split)[few])
            upto = np.cumsum(shorts[group])
            begin = 0
            while begin < len(longs):
                done = upto[begin - 1] if begin else 0
                to = max(begin + 1, int(np.searchsorted(upto, done + _AT_ONCE, "right")))
                each = shorts[group[begin:to]]
                b = np.repeat(longs[begin:to], each)
                a = np.arange(len(b)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(new[group[begin:to]], each)
                keep(a, b)
                begin = to
            if found:
                column = table.column("id").combine_chunks()
                yield pa.RecordBatch.from_arrays([column.take(pa.array(np.concatenate(x))) for x in zip(*found)], names=["id", "id_b"])

    return run, f"id {kind}, id_b {kind}"


def _segment_pairs(classes: DataFrame, threshold: float, longest_short: int) -> DataFrame:
    """``(id, id_b)``: strings of which the shorter has over ``longest_short`` letters and that share an unchanged segment, and whose ends agree; no pair with the ratio is lost.

    Of two strings of a and b letters (a <= b) with the ratio at most ``d = (1 - threshold) *
    (a + b)`` letters are left out of both together, and b is at most ``a * (2 - threshold) /
    threshold``. Count each with the segment of the shorter string in or right before
    which it stands, of ``d + 1`` segments: there is a first segment i up to whose end no
    more than i are counted. None is counted with it, exactly i before it, and ``d - i`` at
    most behind it. So it stands in the longer string as it is, -i, -i + 2, ... or i places
    off. Segments have one length in a class of lengths. Strings too short for that many
    segments meet on single letters.

    A segment that many strings have is dealt to several tasks by the shorter strings; of
    all that meet only pairs go on whose ends, on the side with more letters, can belong
    to strings with the ratio.
    """
    grow = (2 - threshold) / threshold
    order = lambda n: F.floor(F.log(n.cast("double")) / math.log(_CLASS) + 1e-9).cast("int")
    # the shortest string of a class gives the segments' length, the longest their number
    least, most = F.pow(F.lit(_CLASS), F.col("k")), F.pow(F.lit(_CLASS), F.col("k") + 1)
    missing = F.floor((1 - threshold) * (1 + grow) * most + 1e-6).cast("int")
    width = F.greatest(F.lit(1), F.floor(least / (missing + 1)).cast("int"))
    whole = missing + 1 <= F.floor(least)
    low, high = F.ceil(least - 1e-6).cast("int"), F.floor(most + 1e-6).cast("int")
    ends = F.pandas_udf(_packed_ends, "first long, last long")
    rows = classes.withColumn("n", F.length("seq")).where(F.col("n") > longest_short / grow).withColumn("ends", ends("seq"))
    in_class = {"d": missing, "w": width, "whole": whole}
    key = lambda i, at: F.xxhash64(F.col("k"), i, F.substring(F.col("seq"), at + 1, F.col("w")))
    # the end with more letters beside the segment
    end = lambda i: F.when(2 * i < F.col("d"), F.col("ends.last")).otherwise(F.col("ends.first"))
    row = lambda i, at: F.struct(key(i, at).alias("key"), end(i).alias("end"))
    own = rows.where(F.col("n") > longest_short).withColumn("k", order(F.col("n"))).withColumns(in_class)
    number = F.when(F.col("whole"), F.col("d") + 1).otherwise(F.col("n"))
    short = own.select("id", "n", F.explode(F.transform(A.upto(number), lambda i: row(i, i * F.col("w")))).alias("s")).select("s.key", "id", "n", "s.end")
    classes_below = F.sequence(order(F.col("n") / grow), order(F.col("n")))
    there = own.select("k").distinct()
    long = rows.withColumn("k", F.explode(classes_below)).join(F.broadcast(there), "k").withColumns(in_class)
    # how much longer it is than strings of the class, and how far the segment may be off, by what is left out of either and what stands behind it
    less, more = F.greatest(F.col("n") - high, F.lit(0)), F.col("n") - low
    half = F.floor(F.col("d") / 2).cast("int")

    def places(i):
        first = F.greatest(-i, -half, less - (F.col("d") - i))
        last = F.least(i, F.floor((F.col("d") + more) / 2).cast("int"), more + F.col("d") - i)
        first = first + F.pmod(first + i, F.lit(2))
        return F.when(first <= last, F.sequence(first, F.greatest(first, last), F.lit(2))).otherwise(F.array().cast("array<int>"))

    offs = lambda i: F.when(F.col("whole"), places(i)).otherwise(F.sequence(-F.col("d"), F.col("d")))
    inside = lambda at: (at >= 0) & (at + F.col("w") <= F.col("n"))
    at = F.explode(F.flatten(F.transform(A.upto(F.when(F.col("whole"), F.col("d") + 1).otherwise(high)), lambda i: F.transform(F.filter(F.transform(offs(i), lambda s: i * F.col("w") + s), inside), lambda p: F.struct(i.alias("i"), p.alias("at"))))))
    grams = long.select("*", at.alias("p")).select(row(F.col("p.i"), F.col("p.at")).alias("s"), "id", "n").select("s.key", "id", "n", "s.end")
    hot = short.groupBy("key").count().where(F.col("count") > _CELL).select("key", F.ceil(F.col("count") / _CELL).cast("int").alias("cells"))
    dealt = lambda rows, cell: rows.join(F.broadcast(hot), "key", "left").withColumn("cells", F.coalesce("cells", F.lit(1))).withColumn("cell", cell)
    met = dealt(short, F.pmod(F.xxhash64("id"), F.col("cells")).cast("int")).withColumn("long", F.lit(False)).unionByName(dealt(grams, F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).withColumn("long", F.lit(True)))
    # a number of its own, since little data is much work here
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.select("key", "cell", "long", "id", "n", "end").repartition(tasks, "key", "cell").sortWithinPartitions("key", "cell", "long")
    met = met.mapInArrow(*_pairs_of_keys(threshold, classes.schema["id"].dataType.simpleString()))
    return met.select(F.least("id", "id_b").alias("id"), F.greatest("id", "id_b").alias("id_b")).distinct()


def similar_pairs(strings: DataFrame, threshold: float, shared: int = 3, longest_short: int | None = None) -> DataFrame:
    """``(id, id_b, ratio)`` of ``(id, seq)`` rows (unique ids) with an LCS ratio of at least ``threshold``.

    Equal strings form a class, named by its least id: it has a row ``(class, member, 1)``
    for each further member, and pairs are given between classes, the smaller id first.
    Different strings meet on combinations of ``shared`` rare tokens, by which no pair is
    lost; bounds by length and by the tokens' marks come before the exact ratio. Strings
    of over ``longest_short`` letters (default: where combinations would be too many) meet
    on segments instead, one of which stands unchanged in every partner. Rows with a null
    are left out.
    """
    rows = strings.select("id", "seq").dropna()
    classes = _stored(rows.groupBy("seq").agg(F.min("id").alias("id")))
    members = rows.join(classes.select("seq", F.col("id").alias("class")), "seq").where("id <> class").select(F.col("class").alias("id"), F.col("id").alias("id_b"), F.lit(1.0).alias("ratio"))
    limit = longest_short or 1
    while longest_short is None and limit < 1 << 20 and _by_tokens(2 * limit, threshold, shared):
        limit *= 2
    # a pair is the business of the shorter string: tokens up to the limit, segments beyond
    partner = math.ceil(limit * (2 - threshold) / threshold)
    marks = [f"m{k}" for k in range(MARKS)]
    few = classes.where(F.length("seq") <= partner)
    signs = _prefixes(few.select("seq"), threshold, shared).join(few, "seq").select("id", "n", *marks, F.explode(F.array_distinct(_combinations(F.col("rare"), shared))).alias("sign"))
    other = signs.select("sign", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", *marks)])
    total = F.col("n") + F.col("n_b")
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col(m).bitwiseXOR(F.col(f"{m}_b"))) for m in marks])
    met = signs.join(other, "sign").where((F.col("id") < F.col("id_b")) & (F.least("n", "n_b") <= limit) & (2 * F.least("n", "n_b") >= threshold * total) & (differ <= (1 - threshold) * total + 1e-9)).select("id", "id_b").distinct()
    met = met.unionByName(_segment_pairs(classes, threshold, limit))
    whole = met.join(classes, "id").join(classes.select(F.col("id").alias("id_b"), F.col("seq").alias("seq_b")), "id_b")
    # a generator stands between the ratio and its test, so it is worked out once
    tried = whole.select("id", "id_b", F.explode(F.array(lcs_ratio("seq", "seq_b", threshold))).alias("ratio"))
    return tried.where(F.col("ratio") >= threshold).unionByName(members)

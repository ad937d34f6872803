"""Personal data: base patterns and keys as seeds, and lexical patterns bootstrapped from them.

Seeds induce patterns of their surface form (alphabet, grouping, length, first
character) and of the words around them. Spark scores the graph of patterns and values
in rounds: a pattern is as good as its values, a value as good as its best trusted
pattern, until no further pattern is trusted. Trusted patterns find values that no seed
rule knows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, join_hot, positional, written

KINDS = ("email", "ip", "card", "phone")
#: Kind of a span that a learned pattern found.
FOUND = "id"

# Fixed patterns of the base kinds; the e-mail pattern is applied around each "@".
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9.]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_FOUR = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_EDGE = "\"'()[]{}<>,;:.!?*#$%&|=`"
#: Seeds beside the base kinds: keys as programs write them, of 128 bits or more.
_KEY = re.compile(r"(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{32,}")
_HEX = re.compile(r"(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f-]{16,}")
_RUN = re.compile(r"([0-9]+)|([^\W\d_]+)")

#: Normal quantile of the lower confidence bound (90 %, one-sided), and the bound from which a pattern is trusted.
Z, CONFIDENCE = 1.2816, 0.9
#: Patterns that are broadcast at most; more of them meet the candidates in a join.
MOST_BROADCAST = 200_000
#: Words and forms longer than this stand in a pattern as a hash.
LONGEST_WORD = 40


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the base kinds, leftmost and non-overlapping within a kind; failing matches are dropped."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for run in _DOTTED.finditer(text):
            parts = run.group().split(".")
            k, start = 0, run.start()
            while k + 3 < len(parts):  # a match begins and ends with a part between dots
                four = parts[k : k + 4]
                if not all(four):
                    start += len(four[0]) + 1
                    k += 1
                    continue
                end = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out.append(("ip", start, end))
                start, k = end + 1, k + 4
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", *m.span()))
        at = text.find("+")
        while at >= 0:
            m = _PHONE.match(text, at)
            if m and 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
            at = text.find("+", m.end() if m else at + 1)
    return out


def family(value: str) -> str | None:
    """numeric (digits and separators, seven digits or more), hex (16 or more with digits and letters), mail (with @ and a digit), mixed (eight or more with four digits); others are no identifiers."""
    digits = sum(c in "0123456789" for c in value)
    if all(c in "0123456789 +-.()/" for c in value):
        return "numeric" if digits >= 7 else None
    if "@" in value:
        return "mail" if digits else None
    if _HEX.fullmatch(value):
        return "hex"
    return "mixed" if digits >= 4 and len(value) >= 8 else None


def _short(word: str) -> str:
    return word if len(word) <= LONGEST_WORD else f"#{xxhash.xxh64_hexdigest(word.encode('utf-8', 'surrogatepass'))}"


def form(value: str, kind: str) -> str:
    """Surface form: of numbers the grouping with lengths, of hexadecimal the length, of others the order of letters, digits and signs."""
    if kind == "hex":
        return f"x{len(value)}"
    if kind == "numeric":
        return _short(_RUN.sub(lambda m: f"9{{{len(m.group())}}}", value))
    return _short(_RUN.sub(lambda m: "9" if m.group(1) else "a", value))


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, bool, list[str]]]:
    """``(start, end, seed, patterns)`` of base spans, keys and other identifier-like words apart from base spans.

    Patterns: the form; form and first character (neither for values that failed a base
    kind's check); and contexts, which carry values of any
    form: the word before (and the sign that touches the value), two words before, the
    words on both sides.
    """
    taken = sorted((s, e) for _, s, e in base)
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [s for s, _ in words]
    spans = [(s, e, bisect_right(starts, s) - 1, True) for s, e in taken]
    k = 0
    for w, (s, e) in enumerate(words):
        if not _DIGIT.search(text, s, e):
            continue
        cut = text.rfind("=", s, e - 1) + 1
        s = cut if cut > s and _DIGIT.search(text, cut, e) else s
        while s < e and text[s] in _EDGE:
            s += 1
        while e > s and text[e - 1] in _EDGE:
            e -= 1
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if s < e and not (k < len(taken) and taken[k][0] < e):
            spans.append((s, e, w, False))
    for s, e, w, seed in spans:
        value = text[s:e]
        kind = family(value) or ("mixed" if seed else None)
        seed = seed or bool(_KEY.fullmatch(value))
        touch = text[s - 1] if s > starts[w] else ""
        one = f"{_short(text[slice(*words[w - 1])].lower())} {touch}" if w else ""
        two = f"{_short(text[slice(*words[w - 2])].lower())} {one}" if w > 1 else ""
        last = bisect_right(starts, e - 1) - 1
        after = _short(text[slice(*words[last + 1])].lower()) if last + 1 < len(words) else ""
        # what looks like a card or an address and failed its check is no evidence for that form
        failed = not seed and bool(_CARD.fullmatch(value) or _FOUR.fullmatch(value))
        out = [f"{kind} {form(value, kind)}", f"{kind} {form(value, kind)} ^{value[0]}"] if kind and not failed else []
        out += [f"< {one}"] if one else []
        out += [f"<< {two}"] if two else []
        out += [f"<> {one} > {after}"] if one and after else []
        yield s, e, seed, out


def learn(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A written table ``(pattern, confidence, seeds, n)`` of all trusted patterns of ``docs``.

    The graph has an edge for each distinct pattern and value. Seeds count 1, other values
    what the other side says: in a form the confidence of their best trusted context, in a
    context that of their best trusted form. A pattern's confidence is the lower
    bound (Wilson's) of the mean over its values, so that a few seeds prove nothing and
    no pattern lives on others. Rounds go on until no more patterns are trusted;
    confidences only rise, so they end. Null and empty texts add nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 4 << 20):
            found: set[tuple[str, int, bool]] = set()
            for t in b.column("text").to_pylist():
                if t and (_DIGIT.search(t) or "@" in t):
                    for s, e, seed, patterns in candidates(t, base_spans(t)):
                        value = xxhash.xxh64_intdigest(t[s:e].encode("utf-8", "surrogatepass")) >> 1
                        found.update((p, value, seed) for p in patterns)
            cols = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_())], ["pattern", "value", "seed"])

    seen = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "pattern string, value long, seed boolean")
    edges = written(seen.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    stats = edges.groupBy("pattern").agg(F.count_if("seed").alias("seeds"), F.count("*").alias("n"))
    stats = written(stats.where("seeds > 0"), "patterns")
    p, n = (F.col("seeds") + F.col("gain")) / F.col("n"), F.col("n")
    confidence = ((p + Z * Z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)).alias("confidence")
    # what its values could never lift to the bound need not be looked at again
    scored = stats.where(n / (n + Z * Z) >= CONFIDENCE).withColumn("gain", F.lit(0.0))
    stats = scored.drop("gain")
    # only values that are no seeds can change a score
    free = written(join_hot(edges, stats.select("pattern", F.lit(True).alias("known")), "pattern").where("known and not seed").select("pattern", "value"), "free")
    trusted = None
    while True:
        now = written(scored.select("pattern", confidence, "seeds", "n").where(F.col("confidence") >= CONFIDENCE), "trusted")
        count = now.count()
        if count == trusted or not count:
            return now
        trusted = count
        context = F.col("pattern").startswith("<")
        best = join_hot(free, now.select("pattern", "confidence"), "pattern").where("confidence is not null").groupBy("value").agg(F.max(F.when(context, F.col("confidence"))).alias("in_context"), F.max(F.when(~context, F.col("confidence"))).alias("in_form"))
        gain = join_hot(free, best, "value").groupBy("pattern").agg(F.sum(F.coalesce(F.when(context, F.col("in_form")).otherwise(F.col("in_context")), F.lit(0.0))).alias("gain"))
        scored = stats.join(gain, "pattern", "left").withColumn("gain", F.coalesce("gain", F.lit(0.0)))


def spans(text: str | None, patterns: frozenset[str] = frozenset(), places: list[tuple[int, int]] | None = None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and the further ones of the learned patterns (or at ``places``), each by kind as listed and then by start."""
    text = text or ""
    if "@" not in text and not _DIGIT.search(text):
        return [], []
    base = base_spans(text)
    more: list[tuple[str, int, int]] = []
    if places is not None:
        more = sorted((FOUND, s, e) for s, e in places)
    elif patterns:
        known = {(s, e) for _, s, e in base}
        more = [(FOUND, s, e) for s, e, _, own in candidates(text, base) if (s, e) not in known and not patterns.isdisjoint(own)]
    return sorted(base, key=lambda x: (KINDS.index(x[0]), x[1])), more


def _located(rows: DataFrame, patterns: DataFrame, text_col: str) -> DataFrame:
    """``(key, places)`` for the texts of ``rows`` in which a pattern finds values: candidates meet the patterns in a join. The key is the text's SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 4 << 20):
            out: list[tuple] = []
            for t in b.column("text").to_pylist():
                if t and (_DIGIT.search(t) or "@" in t):
                    key, base = hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest(), base_spans(t)
                    known = {(s, e) for _, s, e in base}
                    out += [(key, s, e, p) for s, e, _, own in candidates(t, base) if (s, e) not in known for p in own]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["key", "s", "e", "pattern"])

    found = written(rows.select(F.col(text_col).alias("text")).mapInArrow(run, "key string, s long, e long, pattern string").distinct(), "candidates")
    hit = join_hot(found, patterns.select("pattern", F.lit(True).alias("hit")), "pattern").where("hit").select("key", "s", "e").distinct()
    return hit.groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("places"))


def _prepared(rows: DataFrame, patterns: DataFrame, text_col: str, most: int) -> tuple[DataFrame, object, str | None]:
    """``rows``, the broadcast patterns, and the name of the column of places; there is one only if the patterns are too many to broadcast."""
    few = patterns.select("pattern").limit(most + 1).collect()
    if len(few) <= most:
        return rows, rows.sparkSession.sparkContext.broadcast(frozenset(r["pattern"] for r in few)), None
    key, name = f"key_{uuid.uuid4().hex}", f"places_{uuid.uuid4().hex}"
    keyed = written(rows.withColumn(key, F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)), "keyed")
    found = _located(rows, patterns, text_col).select(F.col("key").alias(key), F.col("places").alias(name))
    return join_hot(keyed, found, key).drop(key), None, name


def _spans_of(batch: pa.RecordBatch, text_col: str, shared, places: str | None) -> list[tuple]:
    texts = batch.column(text_col).to_pylist()
    if places is None:
        return [spans(t, shared.value) for t in texts]
    return [spans(t, places=[(x["s"], x["e"]) for x in p or ()]) for t, p in zip(texts, batch.column(places).to_pylist())]


def _mark(items: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in items)


def find(docs: DataFrame, patterns: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_BROADCAST) -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, n_found, base_sha256, spans)`` for every row; other columns are not read.

    The four counts are of base spans; ``n_found`` counts those of the ``patterns`` of
    ``learn``. Null texts count as empty. Up to ``most`` patterns are broadcast, more of
    them are joined.
    """
    rows, shared, places = _prepared(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), patterns, "text", most)
    names = [f"n_{k}" for k in (*KINDS, "found")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", 4 << 20):
            both = _spans_of(b, "text", shared, places)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in both], pa.int64()) for k in KINDS]
            counts.append(pa.array([len(more) for _, more in both], pa.int64()))
            digest = pa.array([hashlib.sha256(_mark(base).encode()).hexdigest() for base, _ in both], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("id"), *counts, digest, pa.array([_mark(x + y) for x, y in both], pa.string())], ["id", *names, "base_sha256", "spans"])

    counts = ", ".join(f"{n} long" for n in names)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame, patterns: DataFrame, text_col: str = "text", length_col: str = "n_chars", most: int = MOST_BROADCAST) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and the length column, if there is one, set anew.

    Spans that overlap become one, of the kind that begins first (the longest, if
    several do). Null texts stay null, and rows without a span stay as they are.
    """
    own = docs.columns
    docs = positional(docs)  # Arrow functions take no column names with a backtick
    names, text_col, length_col = docs.columns, f"c{own.index(text_col)}", f"c{own.index(length_col)}" if length_col in own else ""
    rows, shared, places = _prepared(docs, patterns, text_col, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text_col, 4 << 20):
            texts, sizes = [], []
            lengths = b.column(length_col).to_pylist() if length_col in names else [None] * len(b)
            for t, n, (base, more) in zip(b.column(text_col).to_pylist(), lengths, _spans_of(b, text_col, shared, places)):
                if base or more:
                    parts, at = [], 0
                    for s, e, k in sorted(((s, e, k) for k, s, e in base + more), key=lambda x: (x[0], -x[1])):
                        if s >= at:
                            parts += [t[at:s], f"<{k}>"]
                        at = max(at, e)
                    t = "".join(parts) + t[at:]
                    n = len(t)
                texts.append(t)
                sizes.append(n)
            new = {text_col: pa.array(texts, pa.string()), length_col: pa.array(sizes, b.schema.field(length_col).type) if length_col in names else None}
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in names], names)

    return rows.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields])).toDF(*own)

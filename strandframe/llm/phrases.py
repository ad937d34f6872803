"""Phrase collocations, counted in weighted acyclic automata.

A transducer reads the words of an n-gram and its last arc bears the count. It is built
from sorted n-grams: as soon as a prefix is left behind its state is complete, and a state
with the same arcs (words, counts and targets) that is registered already takes its place.
Each task builds those of its shard, one for each range of prefixes; transducers of one
range are united by summing weights. Counts of the parts of candidates are found by
composition: an acceptor of the parts that a range asks for meets the transducer of the
range in which they lie, and the answer is a transducer again.

Longer n-grams are counted only where both shorter ones inside them are frequent, which
Bloom filters tell (false positives are counted and dropped).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bloom
from .common import chunks, written

#: Text bytes of a shard, words whose continuations a range holds (about), and ranges at most.
SHARD_BYTES, RANGE_WORDS, MOST_RANGES = 1 << 22, 1 << 20, 1 << 16
#: Letters of a word by which ranges are cut.
CUT_CHARS = 64

_TABLE = "words array<string>, first array<int>, label array<int>, target array<int>, weight array<long>"
_NAMES = ["words", "first", "label", "target", "weight"]
_KINDS = [pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]


@dataclass
class Transducer:
    """``words`` in byte order; state s has the arcs ``first[s]`` to ``first[s + 1]``, by ascending label; the last state is the start.

    An arc's target is -1 where nothing follows, its weight 0 where no n-gram ends.
    """

    words: pa.Array
    first: np.ndarray
    label: np.ndarray
    target: np.ndarray
    weight: np.ndarray

    def row(self) -> list:
        return [self.words, *(pa.array(x) for x in (self.first, self.label, self.target, self.weight))]

    def grams(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length, from 1: the labels of the paths (one row each, in order) and their weights; prefixes without a weight are left out."""
        out, prefix, states = [], np.zeros((1, 0), np.int64), np.array([len(self.first) - 2], np.int64)
        while len(states):
            n = (self.first[states + 1] - self.first[states]).astype(np.int64)
            arcs = np.repeat(self.first[states] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            prefix = np.column_stack([np.repeat(prefix, n, axis=0), self.label[arcs]])
            weight, target = self.weight[arcs], self.target[arcs].astype(np.int64)
            out.append((prefix[weight > 0], weight[weight > 0]))
            prefix, states = prefix[target >= 0], target[target >= 0]
        return out


def packed(cols: list[np.ndarray], size: int) -> np.ndarray:
    """Numbers in the order of the rows of labels (each below ``size``)."""
    key = cols[0].astype(np.int64)
    for c in cols[1:]:
        key = np.unique(key, return_inverse=True)[1].astype(np.int64) * size + c
    return key


def build(words: pa.Array, grams: list[tuple[np.ndarray, np.ndarray]]) -> Transducer:
    """The minimal transducer of distinct n-grams: for each length, from 1, sorted rows of labels and their weights (over 0)."""
    arc = np.dtype([("label", np.int32), ("target", np.int32), ("weight", np.int64)])
    register: dict[bytes, int] = {}
    below: tuple[np.ndarray, np.ndarray] = (np.zeros((0, len(grams)), np.int64), np.zeros(0, np.int64))
    for n in range(len(grams), 0, -1):
        labels, weight = grams[n - 1]
        prefix, target = below
        # prefixes of longer n-grams and n-grams of this length, each once
        rows = np.concatenate([prefix[:, :n], labels.reshape(-1, n)])
        order = np.lexsort(rows.T[::-1]) if len(rows) else np.zeros(0, np.int64)
        rows = rows[order]
        new = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)] if len(rows) else np.zeros(0, bool)
        at = np.cumsum(new) - 1
        arcs = np.zeros(int(new.sum()), arc)
        arcs["target"] = -1
        back = np.empty(len(rows), np.int64)
        back[order] = at
        arcs["target"][back[: len(prefix)]] = target
        arcs["weight"][back[len(prefix) :]] = weight
        rows = rows[new]
        arcs["label"] = rows[:, -1] if len(rows) else 0
        stem = rows[:, : n - 1]
        starts = np.flatnonzero(np.r_[True, (stem[1:] != stem[:-1]).any(axis=1)]) if len(rows) else np.zeros(0, np.int64)
        raw, cuts = arcs.tobytes(), (np.r_[starts, len(rows)] * arc.itemsize).tolist()
        states = [register.setdefault(raw[lo:hi], len(register)) for lo, hi in zip(cuts, cuts[1:])]
        below = (stem[starts], np.array(states, np.int64))
    if not len(below[1]):
        register[b""] = len(register)
    all_arcs = np.frombuffer(b"".join(register), arc)
    first = np.r_[0, np.cumsum([len(x) // arc.itemsize for x in register])].astype(np.int32)
    return Transducer(words, first, *(np.ascontiguousarray(all_arcs[c]) for c in arc.names))


def trimmed(words: pa.Array, grams: list[tuple[np.ndarray, np.ndarray]]) -> Transducer:
    """``build`` with the words that occur only."""
    used = np.unique(np.concatenate([g.ravel() for g, _ in grams])) if grams else np.zeros(0, np.int64)
    return build(words.take(pa.array(used)), [(np.searchsorted(used, g), w) for g, w in grams])


def merged(dictionaries: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """All words once in byte order, and the new numbers of each dictionary's words."""
    coded = pa.chunked_array(dictionaries, pa.string()).combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes, out, at = rank[coded.indices.to_numpy()] if len(coded) else rank[:0], [], 0
    for d in dictionaries:
        out.append(codes[at : at + len(d)])
        at += len(d)
    return coded.dictionary.take(pa.array(order)), out


def united(parts: list[Transducer], least: int = 1, most: bool = False) -> Transducer:
    """The union: weights of equal n-grams are summed (``most``: the largest counts), those below ``least`` dropped."""
    words, numbers = merged([t.words for t in parts])
    found: list[list] = []
    for t, number in zip(parts, numbers):
        for n, (g, w) in enumerate(t.grams()):
            if n == len(found):
                found.append([])
            found[n].append((number[g.astype(np.int64)], w))
    grams = []
    for pieces in found:
        g, w = np.concatenate([x for x, _ in pieces]), np.concatenate([x for _, x in pieces])
        key = packed(list(g.T), max(1, len(words)))
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, np.int64)
        total = (np.maximum if most else np.add).reduceat(w[order], starts) if len(key) else w
        keep = total >= least
        grams.append((g[order][starts][keep], total[keep]))
    return trimmed(words, grams)


def composed(asked: Transducer, counts: Transducer) -> Transducer:
    """What ``asked`` accepts with the weights of ``counts``; n-grams that it has not are left out."""
    words, (one, two) = merged([asked.words, counts.words])
    grams = []
    theirs = counts.grams()
    for n, (g, _) in enumerate(asked.grams()):
        if n == len(theirs):
            break
        other, weight = theirs[n]
        a, b = one[g.astype(np.int64)], two[other.astype(np.int64)]
        key = packed(list(np.concatenate([a, b]).T), max(1, len(words)))
        at = np.searchsorted(key[len(a) :], key[: len(a)])
        at = np.minimum(at, max(0, len(b) - 1))
        hit = key[len(a) :][at] == key[: len(a)] if len(b) else np.zeros(len(a), bool)
        grams.append((a[hit], weight[at[hit]]) if len(b) else (a[:0], weight))
    return trimmed(words, grams)


def _read(table: pa.Table | pa.RecordBatch) -> list[Transducer]:
    """The transducers of the rows, which share the table's memory."""
    cols = [table.column(c) for c in _NAMES]
    cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]
    out = []
    for i in range(table.num_rows):
        values = [c[i].values for c in cols]
        out.append(Transducer(values[0], *(v.to_numpy() for v in values[1:])))
    return out


def _columns(found: list[Transducer]) -> list[pa.Array]:
    """One row for each transducer."""
    out = []
    for values, kind in zip(zip(*[t.row() for t in found]), _KINDS):
        ends = np.r_[0, np.cumsum([len(v) for v in values])]
        out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays([v.cast(kind.value_type) for v in values])))
    return out or [pa.array([], k) for k in _KINDS]


class Ranges:
    """Ranges of prefixes: ``(lang, word, part)`` in order, the first key of each range but the first.

    A word whose continuations fill several ranges has several parts; a hash of the next
    word deals them out. N-grams with the same first two words share a range.
    """

    def __init__(self, keys: list[tuple[str, str, int]]):
        self.keys = sorted(keys)

    def of(self, lang: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First and last range of each of ``words`` (in byte order)."""
        at = np.zeros(len(words) + 1, np.int64)
        at[0] = bisect_left(self.keys, (lang,))
        span = np.zeros(len(words), np.int64)
        for own, word, part in self.keys[at[0] : bisect_right(self.keys, (lang, "\U0010ffff" * 2))]:
            i = bisect_left(words, word) if part == 0 else bisect_right(words, word)
            at[i] += 1
            j = bisect_left(words, word)
            if part and j < len(words) and words[j] == word:
                span[j] += 1
        low = np.cumsum(at)[: len(words)]
        return low, low + span

    def dealt(self, lang: str, words: pa.Array, grams: np.ndarray) -> np.ndarray:
        """The range of each row of labels."""
        text = words.to_pylist()
        low, high = self.of(lang, text)
        first = grams[:, 0]
        out = low[first]
        wide = np.flatnonzero(high[first] > out) if grams.shape[1] > 1 else first[:0]
        if len(wide):
            second, at = np.unique(grams[wide, 1], return_inverse=True)
            h = np.array([zlib.crc32(text[k].encode()) for k in second.tolist()], np.int64)[at]
            out[wide] += h % (high[first[wide]] - low[first[wide]] + 1)
        return out

    def split(self, lang: str, words: pa.Array, grams: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, Transducer]]:
        """A transducer for each range."""
        at = [self.dealt(lang, words, g) if len(g) else np.zeros(0, np.int64) for g, _ in grams]
        return [(int(r), trimmed(words, [(g[a == r], w[a == r]) for a, (g, w) in zip(at, grams)])) for r in np.unique(np.concatenate(at))]


def coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts in byte order, and their numbers in a row, -1 between pieces."""
    low = pc.replace_substring_regex(pc.ascii_lower(texts), "[.,;:!?\n\x0b\x0c\r]+", " \n ")
    low = pc.binary_join_element_wise(pc.replace_substring(low, "\t", " "), "\n", " ")
    flat = pc.split_pattern(low, " ").flatten().dictionary_encode()
    words, codes = flat.dictionary, flat.indices.to_numpy()
    order = pc.sort_indices(words).to_numpy()
    words = words.take(pa.array(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[codes] if len(codes) else np.zeros(0, np.int64)
    # "" comes first; the line break, which no word can be, stands for the end of a piece
    marks = [k for k in (pc.index(words, "").as_py(), pc.index(words, "\n").as_py()) if k >= 0]
    for mark, value in zip((pc.index(words, "").as_py(), pc.index(words, "\n").as_py()), (-2, -1)):
        if mark >= 0:
            codes = np.where(codes == mark, value, codes)
    keep = np.ones(len(words), bool)
    keep[marks] = False
    number = np.cumsum(keep) - 1
    codes = codes[codes != -2]
    codes = np.where(codes < 0, -1, number[np.maximum(codes, 0)]) if len(codes) else codes
    return words.filter(pa.array(keep)), codes


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    for b in chunks(batches, "text", SHARD_BYTES):
        for lang in b.column("lang").unique().to_pylist():
            words, codes = coded(b.column("text").filter(pc.equal(b.column("lang"), lang)))
            if len(words):
                yield lang, words, codes
        pa.default_memory_pool().release_unused()


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()], np.uint64)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return bloom.mixed(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _filter(hashes: DataFrame, most_bytes: int) -> np.ndarray:
    hashes = written(hashes.selectExpr("0 shard", "h"), "hashes")
    return bloom.build(hashes, bloom.sizes({0: hashes.count()}, most_bytes))[0]


def _united(rows: DataFrame, least: int) -> DataFrame:
    """Transducers of a range and language as one."""

    def run(table: pa.Table) -> pa.Table:
        t = united(_read(table), least)
        return pa.Table.from_arrays([table.column("range").slice(0, 1), table.column("lang").slice(0, 1), *_columns([t])], ["range", "lang", *_NAMES])

    return rows.groupBy("range", "lang").applyInArrow(run, f"range long, lang string, {_TABLE}")


def _counted(rows: DataFrame, n: int, ranges: Ranges, known: np.ndarray, least: int) -> DataFrame:
    """Transducers of the n-grams with ``least`` occurrences, counted where both shorter ones inside are ``known`` to the filter."""
    shared = rows.sparkSession.sparkContext.broadcast((ranges, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, known = shared.value
        for lang, words, codes in _by_lang(batches):
            h = _hashes(lang, words)
            if n == 2:
                usual = bloom.contains(known, h)
                good = np.where(codes >= 0, usual[codes], False)
                at = np.flatnonzero(good[:-1] & good[1:])
            else:
                both = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
                pair, inverse = np.unique(codes[both] * len(words) + codes[both + 1], return_inverse=True)
                usual = bloom.contains(known, _joined(h[pair // len(words)], h[pair % len(words)]))
                good = np.zeros(len(codes), bool)
                good[both] = usual[inverse]
                at = np.flatnonzero(good[:-1] & good[1:])
            if not len(at):
                continue
            key, first, count = np.unique(packed([codes[at + k] for k in range(n)], len(words)), return_index=True, return_counts=True)
            grams = np.column_stack([codes[at[first] + k] for k in range(n)])
            empty = [(np.zeros((0, k), np.int64), np.zeros(0, np.int64)) for k in range(1, n)]
            found = ranges.split(lang, words, [*empty, (grams, count.astype(np.int64))])
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int64()), pa.array([lang] * len(found)), *_columns([t for _, t in found])], ["range", "lang", *_NAMES])

    return _united(rows.mapInArrow(run, f"range long, lang string, {_TABLE}"), least)


def _ranges(usual: DataFrame, total: int, range_words: int) -> Ranges:
    """Ranges of about ``range_words`` words, MOST_RANGES at most, from the counts of the frequent words ``(lang, word, f)``."""
    n = min(MOST_RANGES, max(1, -(-total // range_words)))
    mean = max(1, total // max(1, usual.count()))
    spread = usual.select("lang", F.substring("word", 1, CUT_CHARS).alias("word"), F.explode(F.sequence(F.lit(0), F.expr(f"f div {mean}"))).alias("part"))
    dealt = spread.repartitionByRange(n, "lang", "word", "part").groupBy(F.spark_partition_id()).agg(F.min(F.struct("lang", "word", "part")).alias("k"))
    return Ranges([tuple(r["k"]) for r in dealt.collect()] if n > 1 else [])


def counts(docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang", range_words: int = RANGE_WORDS, filter_bytes: int = bloom.MOST_BYTES) -> tuple[DataFrame, Ranges, DataFrame]:
    """``(transducers, ranges, totals)``: n-grams of up to three words that occur ``least`` times, by range; ``(lang, n)`` words in all.

    A to Z become lower case; pieces end at ``.,;:!?`` and line breaks, words at spaces and
    tabs. Null texts are empty, the null language is ``und``.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in _by_lang(batches):
            n = np.bincount(codes[codes >= 0], minlength=len(words))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), words, pa.array(n.astype(np.int64))], ["lang", "word", "f"])

    words = written(rows.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    usual = words.where(F.col("f") >= least)
    total = usual.agg(F.sum("f")).first()[0] or 0
    ranges = _ranges(usual, total, range_words)
    shared = docs.sparkSession.sparkContext.broadcast(ranges)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang in b.column("lang").unique().to_pylist():
                h = _hashes(lang, b.column("word").filter(pc.equal(b.column("lang"), lang)))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang in b.column("lang").unique().to_pylist():
                own = b.filter(pc.equal(b.column("lang"), lang)).sort_by("word")
                found = shared.value.split(lang, own.column("word"), [(np.arange(own.num_rows).reshape(-1, 1), own.column("f").to_numpy())])
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int64()), pa.array([lang] * len(found)), *_columns([t for _, t in found])], ["range", "lang", *_NAMES])

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), _read(b)):
                h, g = _hashes(lang, t.words), t.grams()[1][0] if len(t.grams()) > 1 else np.zeros((0, 2), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(_joined(h[g[:, 0]], h[g[:, 1]]).view(np.int64))], ["h"])

    known = _filter(usual.mapInArrow(hashed, "h long"), filter_bytes)
    pairs = written(_counted(rows, 2, ranges, known, least), "pairs")
    known = _filter(pairs.mapInArrow(paired, "h long"), filter_bytes)
    triples = _counted(rows, 3, ranges, known, least)
    singles = usual.mapInArrow(single, f"range long, lang string, {_TABLE}")
    return written(_united(singles.unionByName(pairs).unionByName(triples), least), "counts"), ranges, totals


def _parts(g: np.ndarray) -> list[np.ndarray]:
    """The parts of n-grams of one length (two or three words), cut by cut: first and rest."""
    return [g[:, :1], g[:, 1:]] if g.shape[1] == 2 else [g[:, :1], g[:, 1:], g[:, :2], g[:, 2:]]


def _asked(t: Transducer) -> list[tuple[np.ndarray, np.ndarray]]:
    """Parts of the n-grams of ``t``, each once, with 1 and the count of the most frequent longer candidate around a part of two words."""
    size, parts = max(1, len(t.words)), {1: [], 2: []}
    for g, w in t.grams()[1:]:
        for p in _parts(g.astype(np.int64)):
            parts[p.shape[1]].append((p, 1 + (w if p.shape[1] == 2 else np.zeros(len(w), np.int64))))
    out = []
    for n in (1, 2):
        p, w = (np.concatenate([x[k] for x in parts[n]]) if parts[n] else np.zeros((0, n) if k == 0 else 0, np.int64) for k in (0, 1))
        key = packed(list(p.T), size)
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, np.int64)
        out.append((p[order][starts], np.maximum.reduceat(w[order], starts) if len(key) else w))
    return out


_SCORED = "lang string, phrase string, a long, l long, r long, score long"


def scored(table: DataFrame, ranges: Ranges, share: int = 50) -> DataFrame:
    """Candidates ``(lang, phrase, a, l, r, score)`` of the transducers of ``counts``, without those inside a longer one with ``share`` percent of their occurrences."""
    shared = table.sparkSession.sparkContext.broadcast(ranges)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for origin, lang, t in zip(b.column("range").to_pylist(), b.column("lang").to_pylist(), _read(b)):
                found = shared.value.split(lang, t.words, _asked(t))
                k = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int64()), pa.array([lang] * k, pa.string()), pa.array([origin] * k, pa.int64()), *_columns([x for _, x in found])], ["range", "lang", "origin", *_NAMES])

    def answer(counts: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if counts.num_rows and asked.num_rows:
            (own,), parts = _read(counts), _read(asked)
            out = [(to, "counts", composed(p, own)) for to, p in zip(asked.column("origin").to_pylist(), parts)]
            out.append((counts.column("range")[0].as_py(), "longer", united(parts, most=True)))
        lang = counts.column("lang")[0].as_py() if counts.num_rows else ""
        cols = [pa.array([to for to, _, _ in out], pa.int64()), pa.array([lang] * len(out), pa.string()), pa.array([kind for _, kind, _ in out], pa.string()), *_columns([t for _, _, t in out])]
        return pa.Table.from_arrays(cols, ["range", "lang", "kind", *_NAMES])

    def score(counts: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if counts.num_rows:
            (t,), kinds = _read(counts), answers.column("kind").to_pylist()
            found = list(zip(kinds, _read(answers)))
            parts = {k: united([p for x, p in found if x == k], most=True) if k in kinds else None for k in ("counts", "longer")}
            table = {k: _weights(p) for k, p in parts.items()}
            words, lang = t.words.to_pylist(), counts.column("lang")[0].as_py()
            for g, w in t.grams()[1:]:
                for labels, a in zip(g.tolist(), w.tolist()):
                    gram = tuple(words[x] for x in labels)
                    if len(gram) == 2 and 100 * (table["longer"].get(gram, 1) - 1) >= share * a:
                        continue
                    cuts = []
                    for k in range(1, len(gram)):
                        left, right = table["counts"][gram[:k]], table["counts"][gram[k:]]
                        cuts.append((1_000_000 * a * a // (left * right), k, left, right))
                    s, _, left, right = min(cuts)
                    rows.append((lang, " ".join(gram), a, left, right, s))
        cols = list(zip(*rows)) or [()] * 6
        return pa.Table.from_arrays([pa.array(c, pa.string() if k < 2 else pa.int64()) for k, c in enumerate(cols)], ["lang", "phrase", "a", "l", "r", "score"])

    asked = table.mapInArrow(ask, f"range long, lang string, origin long, {_TABLE}")
    answers = table.groupBy("range", "lang").cogroup(asked.groupBy("range", "lang")).applyInArrow(answer, f"range long, lang string, kind string, {_TABLE}")
    return table.groupBy("range", "lang").cogroup(answers.groupBy("range", "lang")).applyInArrow(score, _SCORED)


def _weights(t: Transducer | None) -> dict[tuple[str, ...], int]:
    if t is None:
        return {}
    words = t.words.to_pylist()
    return {tuple(words[x] for x in labels): n for g, w in t.grams() for labels, n in zip(g.tolist(), w.tolist())}


def collocations(docs: DataFrame, most: int = 2000, least: int = 10, text_col: str = "text", lang_col: str = "lang", range_words: int = RANGE_WORDS, filter_bytes: int = bloom.MOST_BYTES) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``most`` phrases of two or three words.

    See ``counts`` for words. By score, then count, both falling, then the phrase in byte
    order. Languages without a candidate have no row. Other columns are not read.
    """
    table, ranges, totals = counts(docs, least, text_col, lang_col, range_words, filter_bytes)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    top = scored(table, ranges).withColumn("rank", rank).where(F.col("rank") <= most)
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

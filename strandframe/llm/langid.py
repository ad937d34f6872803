"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

Words of letters, in lower case and between two boundary marks, are scored character by
character. A language has, for each order, the sorted hashes of its own n-grams with their
log probabilities (the back-off is worked out when it is trained), and the sorted hashes
of its contexts with the back-off weights.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, positional, written

_WORDS = re.compile(r"[^\W\d_]+")
#: Documents for each language that training takes, bytes over which it takes one only for want of shorter ones, different words for each language, and of all languages together.
SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_WORDS, ALL_WORDS = 800, 1 << 16, 100_000, 2_000_000
#: Stretches of five words of a document that tell how short texts spread.
STRETCHES = 100
ORDER = 5
#: Words whose scores a worker keeps, and words that it scores at a time, which bounds the tables of n-grams beside them.
KEPT_WORDS, SLICE_WORDS = 200_000, 4096


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; other numerals and signs, which patterns take for word characters, are left out."""
    found = _WORDS.findall(text.lower())
    return found if all(map(str.isalpha, found)) else [x for w in found if (x := "".join(filter(str.isalpha, w)))]


def _grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For orders 0 to ORDER the hash of the n-gram that ends at each character; the index of its word, the place in it."""
    text = "".join(f" {w} " for w in words)
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(cp)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes = [np.zeros(len(cp), np.uint64)]
    for n in range(1, ORDER + 1):
        back = np.r_[np.zeros(min(n - 1, len(cp)), np.uint64), cp[: max(0, len(cp) - n + 1)]]
        x = (hashes[-1] ^ (back + np.uint64(n << 32))) * np.uint64(0x9E3779B97F4A7C15)
        hashes.append(x ^ (x >> np.uint64(29)))
    return hashes, word, place


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted array, -1 where it is absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _counts(words: Counter) -> list[dict]:
    """By order: each n-gram's hash, context and suffix, its Kneser-Ney count and the discount."""
    hashes, word, place = _grams(list(words))
    weight = np.fromiter(words.values(), np.float64, len(words))
    out: list[dict] = [{} for _ in range(ORDER + 1)]
    above = None
    for n in range(ORDER, 0, -1):
        at = np.flatnonzero(place >= max(1, n - 1))
        g, first, inverse = np.unique(hashes[n][at], return_index=True, return_inverse=True)
        count = np.bincount(inverse, weight[word[at]], len(g))
        if above is not None:  # a lower order counts the characters seen before it, unless the word begins with it
            inner = place[at][first] > n - 1
            kinds = np.bincount(_find(g, above), minlength=len(g)).astype(float)
            count = np.where(inner | (n == 1), np.maximum(kinds, 1), count)
        above = hashes[n - 1][at][first]
        once, twice = (count == 1).sum(), (count == 2).sum()
        out[n] = {"g": g, "ctx": hashes[n - 1][at - 1][first], "suf": above, "count": count, "d": min(0.95, max(0.1, once / max(1, once + 2 * twice)))}
    return out


class Model:
    """Languages, each with its tables by order and, for rejection, the cross-entropy that its documents have."""

    def __init__(self, words: dict[str, Counter]):
        self.languages = sorted(words)
        counts = [_counts(words[k]) for k in self.languages]
        self.floor = -np.log(max([1, *(len(c[1]["g"]) for c in counts)]) + 1.0)
        self.tables = [self._table(c) for c in counts]
        self.usual: dict[str, tuple[float, float, float]] = {}

    def _table(self, counts: list[dict]) -> list[tuple[np.ndarray, ...]]:
        """For orders from 1: n-grams and their log probabilities, contexts and their back-off weights."""
        out: list[tuple[np.ndarray, ...]] = []
        for n in range(1, ORDER + 1):
            c = counts[n]
            ctx, j = np.unique(c["ctx"], return_inverse=True)
            total, kinds = np.bincount(j, c["count"], len(ctx)), np.bincount(j, minlength=len(ctx))
            back = np.log(c["d"] * kinds / total) if len(ctx) else np.zeros(0)
            lower = np.full(len(c["g"]), self.floor)
            if n > 1:
                at = _find(out[-1][0], c["suf"])
                lower = np.where(at >= 0, out[-1][1][at], self.floor) if len(out[-1][0]) else lower
            log_p = np.log(np.maximum(c["count"] - c["d"], 0) / total[j] + np.exp(back[j] + lower))
            out.append((c["g"], log_p, ctx, back))
        return out

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        hashes, word, place = _grams(words)
        targets = np.flatnonzero(place >= 1)
        # each different n-gram is looked up once in a language, in the order of the hashes
        unique = [np.unique(h, return_inverse=True) for h in hashes]
        grams, contexts = [i[targets] for _, i in unique], [i[targets - 1] for _, i in unique]
        ends = np.cumsum(np.bincount(word[targets], minlength=len(words)))
        out = np.zeros((len(words), len(self.languages)))
        for k, table in enumerate(self.tables):
            total, left = np.zeros(len(targets)), np.arange(len(targets))
            for n in range(ORDER, 0, -1):
                g, log_p, ctx, back = table[n - 1]
                whole = place[targets[left]] >= n - 1
                found = np.where(whole, _find(g, unique[n][0])[grams[n][left]], -1)
                hit = found >= 0
                total[left[hit]] += log_p[found[hit]]
                missed = left[whole & ~hit]
                at = _find(ctx, unique[n - 1][0])[contexts[n - 1][missed]]
                if len(back):
                    total[missed] += np.where(at >= 0, back[at], 0)
                left = left[~hit]
            total[left] += self.floor
            sums = np.r_[0, np.cumsum(total)]
            if len(words):
                out[:, k] = sums[ends] - sums[np.r_[0, ends[:-1]]]
        return out

    def calibrate(self, found: list[tuple[str, float, list[float], list[int]]]) -> None:
        """From documents that were not counted, each ``(language, cross-entropy, that of its stretches, their lengths)``: mean, deviation by document and by character."""
        for lang in self.languages:
            own = [x for x in found if x[0] == lang]
            if own:
                whole = np.array([x[1] for x in own])
                spread = whole.std() if len(whole) > 1 else 0.5
                h, n = (np.concatenate([np.array(x[i], float) for x in own]) for i in (2, 3))
                by_char = float(np.sqrt(np.mean((h - whole.mean()) ** 2 * n)))
                self.usual[lang] = (float(whole.mean()), float(max(spread, 0.05)), max(by_char, 2.5))


class Scorer:
    """Scores lists of words; keeps what it has found for words that come again."""

    def __init__(self, model: Model):
        self.model, self.at, self.table = model, {}, np.zeros((0, len(model.languages)))

    def __call__(self, docs: list[list[str]]) -> list[tuple[np.ndarray, int]]:
        """For each document its log probability by language and its number of scored characters."""
        new = list({w for words in docs for w in words if w not in self.at})
        if len(self.at) + len(new) > KEPT_WORDS:
            self.at, self.table = {}, self.table[:0]
            new = list({w for words in docs for w in words})
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        self.table = np.vstack([self.table, *(self.model.score_words(new[i : i + SLICE_WORDS]) for i in range(0, len(new), SLICE_WORDS))])
        out = []
        for words in docs:
            rows = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
            out.append((self.table[rows].sum(0), sum(map(len, words)) + len(words)))
        return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", keep=None, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from at most ``sample_docs`` documents of each language (whole texts), the first by a hash of the text; those of over SAMPLE_BYTES only where shorter ones are too few.

    ``keep``: a condition on rows that may be learned from. Copies count once. Words are
    counted in tasks; the most frequent of a language reach the driver, SAMPLE_WORDS at
    most and ALL_WORDS of all languages together. One in five of the sample only
    calibrates, unless the language has no other. Rows without a text or language teach
    nothing; no such row: None.
    """
    spark = docs.sparkSession
    size = F.octet_length(text_col)
    rows = docs.where(F.col(label_col).isNotNull() & (size > 0))
    rows = (rows if keep is None else rows.where(keep)).select(F.col(label_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"), size.alias("size"))
    # each task keeps the first documents of its languages, so no language is gathered in one
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("size") > SAMPLE_BYTES, "h"))
    keys = rows.groupBy("lang", "h").agg(F.min("size").alias("size")).withColumn("k", first).where(F.col("k") <= sample_docs)
    counting = F.max(F.col("h") % 5 != 0).over(Window.partitionBy("lang"))
    keys = written(keys.select("lang", "h", (counting & (F.col("h") % 5 == 0)).alias("test")), "keys")
    sample = written(rows.join(keys, ["lang", "h"]).select("lang", "h", "test", "text").dropDuplicates(["lang", "h"]), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            found = Counter((lang, w) for lang, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()) for w in words_of(t))
            cols = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "word", "n"])

    counted = written(sample.where("not test").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "counted")
    languages = counted.select("lang").distinct().count()
    most = min(SAMPLE_WORDS, ALL_WORDS // max(1, languages))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "word", "n").toArrow()
    words: dict[str, Counter] = {}
    for lang, word, n in zip(*(top.column(c).to_pylist() for c in ("lang", "word", "n"))):
        words.setdefault(lang, Counter())[word] = n
    if not words:
        return None
    model = Model(words)
    shared = spark.sparkContext.broadcast(model)

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        at = {x: k for k, x in enumerate(shared.value.languages)}
        for b in chunks(batches, "text"):
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                own = words_of(text) if lang in at else []
                if own:
                    (p, n), *parts = scorer([own, *(own[i : i + 5] for i in range(0, min(len(own), 5 * STRETCHES), 5))])
                    k = at[lang]
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "h": [-p[k] / n], "parts": [[float(-q[k] / m) for q, m in parts]], "sizes": [[m for _, m in parts]]})

    tests = sample.where("test").mapInArrow(tried, "lang string, h double, parts array<double>, sizes array<long>").orderBy("lang", "h").toArrow()
    model.calibrate(list(zip(*(tests.column(c).to_pylist() for c in ("lang", "h", "parts", "sizes")))))
    return model


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", z: float = 8.0, prefix: str = "") -> DataFrame:
    """``docs`` and ``lang_pred string``, ``score double``, ``rejected boolean``, named with ``prefix``; input columns of these names are replaced.

    The language with the lowest cross-entropy per character wins (the first by name if
    equal); score is its share of the softmax over at most 50 characters' worth of
    evidence. Texts that are null or without a letter are ``und``, score 0, rejected.
    Others are rejected if their cross-entropy lies ``z`` deviations above what is usual
    for the language; a language that nothing calibrates rejects none. Without a model
    all texts are ``und``.
    """
    added = [prefix + c for c in ("lang_pred", "score", "rejected")]
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(*kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scorer = own and Scorer(own)
        for b in chunks(batches, text_col):
            lang, score, rejected = [], [], []
            words = [words_of(t.as_py()) if t.is_valid else [] for t in b.column(text_col)]
            for total, n in scorer(words) if own else [(None, 0)] * len(words):
                if not n:
                    lang.append("und"), score.append(0.0), rejected.append(True)
                    continue
                mean = total / n
                k = int(mean.argmax())
                e = np.exp((mean - mean[k]) * min(n, 50))
                usual, by_doc, by_char = own.usual.get(own.languages[k], (np.inf, 1.0, 1.0))
                lang.append(own.languages[k]), score.append(float(1 / e.sum()))
                rejected.append(bool(-mean[k] > usual + z * np.sqrt(by_doc**2 + by_char**2 / n)))
            cols = [b.column(c) for c in kept] + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, [*kept, *added])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, schema + ", `{}` string, `{}` double, `{}` boolean".format(*added))

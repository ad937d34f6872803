"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

A word's edits are not made as strings but as hashes: a word's hash is the sum of a value for
each place and letter, so that of an edit needs a few additions. Filters of the vocabulary,
one for each length, are broadcast; an edit that its filter lets through is written out
and meets the vocabulary in an exact join, which removes the false positives. Of two
words that differ in length the longer one makes the shorter (deletions); of two equally
long ones the one with the smaller letter makes the other. So each pair is found once.

Filters take a bounded number of bytes: a vocabulary beyond that is handled in several
passes, each over the words whose hashes fall into its share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import join_hot, written

#: Lengths with a filter of their own; longer words share the last.
LENGTHS = 64
#: Letters that a replaced letter may become: what ``RUN`` takes after A to Z became lower case.
RUN = r"[A-Za-zÀ-ÿ]+"
_ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.int64)
#: Probes that a task makes at a time.
PROBES = 1 << 21


def vocabulary(docs: DataFrame, least_count: int = 3, least_length: int = 5, drop: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of whole texts: runs of ``RUN`` with A to Z in lower case; null texts have none.

    Where ``drop`` divides the CRC-32 of ``id:run`` the run lacks one letter, at that
    number modulo its length. Runs are counted within tasks before they are shuffled.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.translate(text_col, upper, upper.lower()), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    rest = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % drop == 0, rest).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _value(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """The summand of a letter at a place."""
    return bloom.mixed((place.astype(np.uint64) << np.uint64(32)) + letter.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """Hashes of equally long words, rows of code points."""
    n = letters.shape[1]
    return bloom.mixed(_value(np.broadcast_to(np.arange(n), letters.shape), letters).sum(axis=1, dtype=np.uint64) + np.uint64(n))


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64).reshape(len(words), -1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices and letters of equally long words, few enough for PROBES."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == n)
        step = max(1, PROBES // (n * len(_ALPHABET)))
        for k in range(0, len(at), step):
            yield at[k : k + step], _letters([words[i] for i in at[k : k + step]])


def _share(h: np.ndarray, passes: int) -> np.ndarray:
    return h % np.uint64(passes)


def deletions(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, place and hash of each different deletion (of equal letters in a row only the first goes)."""
    n = letters.shape[1]
    place = np.broadcast_to(np.arange(n), letters.shape)
    here, before = _value(place, letters), _value(place - 1, letters)
    zero = np.zeros((len(letters), 1), np.uint64)
    left = np.hstack([zero, np.cumsum(here, axis=1, dtype=np.uint64)[:, :-1]])
    right = np.hstack([np.cumsum(before[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1][:, 1:], zero])
    word, at = np.nonzero(np.hstack([np.ones((len(letters), 1), bool), letters[:, 1:] != letters[:, :-1]]))
    return word, at, bloom.mixed(left[word, at] + right[word, at] + np.uint64(n - 1))


def replacements(letters: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """By place: word, the place, the new letter and hash of each replacement by a larger letter."""
    n = letters.shape[1]
    place = np.broadcast_to(np.arange(n), letters.shape)
    here = _value(place, letters)
    total = here.sum(axis=1, dtype=np.uint64) + np.uint64(n)
    for at in range(n):
        new = _value(np.full(len(_ALPHABET), at), _ALPHABET)
        word, k = np.nonzero(_ALPHABET[None, :] > letters[:, at : at + 1])
        yield word, at, _ALPHABET[k], bloom.mixed((total - here[:, at])[word] + new[k])


def _candidates(words: DataFrame, filters: dict[int, np.ndarray], passes: int, now: int) -> DataFrame:
    """``(word, n, near)``: edits of each word that a filter lets through."""
    shared = words.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for b in batches:
            words, counts = b.column("word").to_pylist(), b.column("n").to_numpy()
            for index, letters in _by_length(words):
                n, row, near = letters.shape[1], [], []
                text = [words[i] for i in index]

                def passed(size, word, h):
                    own = np.flatnonzero(_share(h, passes) == np.uint64(now)) if passes > 1 else np.arange(len(h))
                    table = filters.get(min(size, LENGTHS))
                    return own[bloom.contains(table, h[own])] if table is not None else own[:0]

                word, at, h = deletions(letters)
                for k in passed(n - 1, word, h):
                    row.append(word[k])
                    near.append(text[word[k]][: at[k]] + text[word[k]][at[k] + 1 :])
                for word, place, letter, h in replacements(letters):
                    for k in passed(n, word, h):
                        row.append(word[k])
                        near.append(text[word[k]][:place] + chr(letter[k]) + text[word[k]][place + 1 :])
                if row:
                    at = index[np.array(row)]
                    yield pa.RecordBatch.from_arrays([b.column("word").take(pa.array(at)), pa.array(counts[at]), pa.array(near, pa.string())], ["word", "n", "near"])

    return words.mapInArrow(run, "word string, n long, near string")


def pairs(words: DataFrame, filter_bytes: int = bloom.MOST_BYTES) -> DataFrame:
    """``(word, n, near, near_n)``: each pair of words one edit apart, once, from ``words (word, n)``, which is read several times."""
    length = F.least(F.char_length("word"), F.lit(LENGTHS))
    keys = {r["s"]: r["k"] for r in words.groupBy(length.alias("s")).agg(F.count("*").alias("k")).collect()}
    passes = max(1, -(-sum(keys.values()) * bloom.KEY_BITS // (8 * filter_bytes)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("word").to_pylist()
            for index, letters in _by_length(words):
                shard = min(letters.shape[1], LENGTHS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(index), shard, np.int32)), pa.array(word_hashes(letters).view(np.int64))], ["shard", "h"])

    hashes = words.mapInArrow(hashed, "shard int, h long")
    if passes > 1:
        hashes = written(hashes, "hashes")
    found = []
    for now in range(passes):
        # unsigned remainder of a signed number
        own = hashes if passes == 1 else hashes.where(F.expr(f"pmod(pmod(h, {passes}) + if(h < 0, {(1 << 64) % passes}, 0), {passes}) = {now}"))
        filters = bloom.build(own, bloom.sizes({s: -(-k // passes) for s, k in keys.items()}, filter_bytes))
        probed = _candidates(words, filters, passes, now)
        exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
        found.append(written(probed.join(exact, "near").select("word", "n", "near", "near_n"), "near"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def variants(words: DataFrame, ratio: int = 2, filter_bytes: int = bloom.MOST_BYTES) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of each row of ``words (word string, n long)``, a written table of different words.

    ``form`` is the near word with the largest n (of equals the first in code-point order)
    if that is at least ``ratio`` (over 1) times the word's; ``root`` is where following forms
    ends, the word itself without a form.
    """
    near = pairs(words, filter_bytes)
    both = near.unionByName(near.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
    told = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("best.near_n") >= ratio * F.col("n"), F.col("best")).alias("best"))
    told = written(told.select("word", "n", "n_near", F.col("best.near").alias("form"), F.col("best.near_n").alias("form_n")), "forms")
    # each round doubles the steps that a pointer has gone; n rises with each step, so there is no circle
    ends = told.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = join_hot(ends, ends.select(F.col("word").alias("root"), F.col("root").alias("further")), "root")
        step = written(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        ends = step.select("word", "root")
        if not step.where("moved").take(1):
            break
    return told.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def group(docs: DataFrame, least_count: int = 3, least_length: int = 5, drop: int = 97, ratio: int = 2, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = bloom.MOST_BYTES) -> DataFrame:
    """``variants`` of the ``vocabulary`` of documents; other columns are not read, a null id counts as empty, an empty table has no rows."""
    return variants(written(vocabulary(docs, least_count, least_length, drop, id_col, text_col), "vocabulary"), ratio, filter_bytes)

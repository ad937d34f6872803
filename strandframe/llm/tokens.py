"""Token counts of whole documents; huge ones are encoded in overlapping chunks that are spliced where both agree.

A chunk is encoded with the offsets of its tokens. Two chunks that share an overlap may be
spliced at a place p (see ``common_boundary``) because of two facts:

* The pre-tokenizer cuts runs of one class (letters, one digit, signs) and drops white
  space. Its matches are settled by what stands left of their end and the three characters
  after it. So where both chunks begin a word at p, away from the ends, the document does.
* Byte-pair merges are local: a row of tokens is the encoding of its text exactly if each
  neighbouring pair is the encoding of the pair's text. So where both chunks hold the same
  two tokens around p inside a word, each pair of the spliced row stands in one of them.

Where no such place is found the document is cut again with overlaps, and chunks, of eight
times the width; at last it is one chunk.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, written

#: Code points of a chunk without its overlap, of an overlap, and the factor by which both widen.
CHUNK_CHARS, OVERLAP_CHARS, WIDEN = 1 << 15, 512, 8
#: Code points of chunks that a task encodes, about.
TASK_CHARS = 1 << 21
#: Units whose token counts a worker keeps, and bytes of the longest one it keeps.
KEPT_UNITS, UNIT_BYTES = 1 << 20, 64

# Fixed values of the vocabulary file: its pre-tokenizer's pattern and its normalizers.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


class Counter:
    """Token counts and encodings by one vocabulary file (``tokenizers`` for ``.json``, ``sentencepiece`` for ``.model``).

    ``local`` tells whether the file has the pre-tokenizer whose boundaries are proven
    above. Then texts are counted by units (what stands between spaces, its last full
    stop or comma apart), since a unit's tokens do not depend on its neighbours; counts
    of units are kept, KEPT_UNITS at most. Other files encode whole texts.
    """

    def __init__(self, path: str):
        self.local, self.known = False, {}
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.sizes = lambda texts: [len(x) for x in self.model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path) as f:
            said = json.load(f)
        first = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        names = [x.get("type") for x in (said.get("normalizer") or {}).get("normalizers", [])]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.local = plain and first.get("pattern") == {"Regex": _PATTERN} and first.get("invert") is True and names == _NORMALIZERS
        #: A special string that covers a place lies within this distance of it.
        self.margin = max(map(len, ["'re", *self.special]))
        self.sizes = lambda texts: list(map(len, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (no nulls)."""
        if not self.local:
            return np.array(self.sizes(texts.to_pylist()), np.int64)
        small = pc.ascii_lower(texts)
        special = pc.fill_null(pc.match_substring(small, self.special[0].lower()), False) if self.special else pa.array([False] * len(texts))
        for s in self.special[1:]:
            special = pc.or_(special, pc.match_substring(small, s.lower()))
        # lower case could turn another string into a special one; such texts stay as they are
        small = pc.if_else(special, texts, small)
        small = pc.replace_substring_regex(pc.replace_substring(small, "\n", " "), "([a-z])([.,])", r"\1 \2")
        parts = pc.split_pattern(small, " ")
        units = parts.flatten().dictionary_encode()
        n = np.array(self._unit_counts(units.dictionary.to_pylist()), np.int64)
        each = np.r_[0, np.cumsum(n[units.indices.to_numpy()] if len(units) else n[:0])]
        ends = parts.offsets.to_numpy() - parts.offsets[0].as_py() if len(parts) else np.zeros(1, np.int64)
        return each[ends[1:]] - each[ends[:-1]]

    def _unit_counts(self, units: list[str]) -> list[int]:
        new = [u for u in units if u not in self.known]
        found = dict(zip(new, self.sizes(new)))
        short = {u: n for u, n in found.items() if len(u) <= UNIT_BYTES}
        if len(self.known) + len(short) > KEPT_UNITS:
            found = {u: self.known[u] for u in units if u in self.known} | found
            self.known = {}
        self.known.update(short)
        return [self.known[u] if u in self.known else found[u] for u in units]

    def tokens(self, texts: list[str]) -> list[np.ndarray]:
        """For each text an array of rows: id, start, end, and whether a word begins there."""
        out = []
        for e in self.tokenizer.encode_batch(texts, add_special_tokens=False):
            spans = np.array(e.offsets, np.int64).reshape(-1, 2)
            words = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
            out.append(np.column_stack([np.array(e.ids, np.int64), spans, np.r_[True, words[1:] != words[:-1]][: len(words)].astype(np.int64)]))
        return out


@lru_cache(2)
def counter_of(path: str) -> Counter:
    """The file's counter, kept with its counts from task to task of a worker."""
    return Counter(path)


def _settled(c: str) -> bool:
    """Whether normalisation never joins ``c`` to what stands before it."""
    return unicodedata.category(c)[0] in "LNPSZ" and not "\u1160" <= c <= "\u11ff" and (c < "\ud800" or unicodedata.category(c) == "So")


def common_boundary(left: np.ndarray, right: np.ndarray, low: int, high: int, text: str, begin: int) -> tuple[int, int] | None:
    """``(i, j)``: token i of ``left`` and token j of ``right`` begin at one stable place in [low, high]; None if there is none.

    Tokens are rows of ``Counter.tokens`` with offsets in the document; ``text`` is the
    overlap, which begins at ``begin``.
    """
    a, b = left[:, 1], right[:, 1]
    # a place has a row of its own only if the token before it ends there or earlier
    own_a = np.flatnonzero((a[1:] > a[:-1]) & (left[:-1, 2] <= a[1:])) + 1
    own_b = np.flatnonzero((b[1:] > b[:-1]) & (right[:-1, 2] <= b[1:])) + 1
    places, x, y = np.intersect1d(a[own_a], b[own_b], return_indices=True)
    for p, i, j in zip(places.tolist(), own_a[x].tolist(), own_b[y].tolist()):
        if low <= p <= high and left[i, 3] == right[j, 3] and _settled(text[p - begin]):
            if left[i, 3] or (left[i - 1 : i + 1] == right[j - 1 : j + 1])[:, :3].all():
                return i, j
    return None


def _cut(huge: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``(row, part, begin, last, text)`` of ``(row, text)``: chunks of ``chunk`` code points and their overlap with the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                n = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(n):
                    part = text[k * chunk : (k + 1) * chunk + overlap] if k < n - 1 else text[k * chunk :]
                    yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int64()), "part": pa.array([k], pa.int64()), "begin": pa.array([k * chunk], pa.int64()), "last": [k == n - 1], "text": [part]})

    return huge.mapInArrow(run, "row long, part long, begin long, last boolean, text string")


_EDGE = "array<struct<id:long,start:long,end:long,word:long>>"


def _encoded(parts: DataFrame, path: str, overlap: int) -> DataFrame:
    """``(row, part, n, head, tail, text)``: tokens of each chunk, those of the overlaps at both ends, and the overlap at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for b in (c for x in batches for c in chunks([x], "text")):
            texts, begins, last = (b.column(c).to_pylist() for c in ("text", "begin", "last"))
            n, heads, tails, texts_out = [], [], [], []
            for text, begin, end, t in zip(texts, begins, last, counter.tokens(texts)):
                n.append(len(t))
                head = np.searchsorted(t[:, 1], overlap)
                tail = len(t) if end else np.searchsorted(t[:, 1], len(text) - overlap)
                t = t + np.array([0, begin, begin, 0])
                rows = lambda x: [dict(zip(("id", "start", "end", "word"), r)) for r in x.tolist()]
                heads.append(rows(t[:head]) if begin else [])
                tails.append(rows(t[tail:]))
                texts_out.append("" if end else text[len(text) - overlap :])
            edge = pa.list_(pa.struct([(c, pa.int64()) for c in ("id", "start", "end", "word")]))
            cols = [b.column("row"), b.column("part"), b.column("begin"), b.column("last"), pa.array(n, pa.int64()), pa.array(heads, edge), pa.array(tails, edge), pa.array(texts_out, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["row", "part", "begin", "last", "n", "head", "tail", "text"])

    return parts.mapInArrow(run, f"row long, part long, begin long, last boolean, n long, head {_EDGE}, tail {_EDGE}, text string")


def _spliced(encoded: DataFrame, path: str) -> DataFrame:
    """``(row, extra)`` for each boundary between chunks: tokens that both count; null where no stable place is common."""
    left = encoded.where("not last").select("row", (F.col("part") + 1).alias("part"), "tail", "text")
    pairs = left.join(encoded.select("row", "part", "begin", "head"), ["row", "part"]).select("row", "begin", "tail", "head", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        table = lambda x: np.array([(t["id"], t["start"], t["end"], t["word"]) for t in x], np.int64).reshape(-1, 4)
        for b in batches:
            extra = []
            for begin, tail, head, text in zip(*(b.column(c).to_pylist() for c in ("begin", "tail", "head", "text"))):
                tail, head = table(tail), table(head)
                at = common_boundary(tail, head, begin + counter.margin, begin + len(text) - counter.margin, text, begin)
                extra.append(None if at is None else len(tail) - at[0] + at[1])
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(extra, pa.int64())], ["row", "extra"])

    return pairs.mapInArrow(run, "row long, extra long")


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of each row; null texts count as empty, repeated rows stay.

    Texts of up to ``chunk_chars`` and an overlap are counted where they are. Chunks of
    longer ones are dealt out, so that a huge document keeps many tasks busy. Other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    whole = F.char_length("text") <= chunk_chars + overlap_chars
    if path.endswith(".model") or not counter_of(path).local:
        whole = F.lit(True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for b in chunks(batches, "text", 1 << 22):
            text = b.column("text")
            cols = [b.column("id"), pc.binary_length(text).cast(pa.int64()), pa.array(counter.counts(text), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "n_bytes", "n_tokens"])

    parts = [rows.where(whole).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")]
    huge = written(rows.where(~whole).withColumn("row", F.monotonically_increasing_id()), "huge")
    left, chunk, overlap = huge.select("row", "text"), chunk_chars, overlap_chars
    while left.take(1):
        size = left.agg(F.sum(F.char_length("text"))).first()[0]
        dealt = _cut(left, chunk, overlap).repartition(-(-size // TASK_CHARS), "row", "part")
        encoded = written(_encoded(dealt, path, overlap), "encoded")
        spliced = written(_spliced(encoded, path), "spliced")
        open_rows = spliced.where("extra is null").select("row").distinct()
        sums = encoded.select("row", F.col("n").alias("n")).unionByName(spliced.select("row", (-F.col("extra")).alias("n")))
        done = sums.join(open_rows, "row", "left_anti").groupBy("row").agg(F.sum("n").alias("n_tokens"))
        parts.append(huge.select("id", "row", F.octet_length("text").cast("long").alias("n_bytes")).join(done, "row").select("id", "n_bytes", "n_tokens"))
        left, chunk, overlap = left.join(open_rows, "row", "left_semi"), chunk * WIDEN, overlap * WIDEN
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

"""Toxic spans by a linear-chain conditional random field with the labels clean and toxic.

Documents are labelled, tokens are not: tokens whose word, prefix or suffix is tied to
toxic documents are labelled toxic, and the field is fitted to those token labels.
Forward-backward marginals then tag spans and are combined into a document's score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks
from .simhash import shingle_hashes

WORDS = re.compile(r"[^\W\d_]+")
#: Bounds of the training sample: toxic and clean documents, bytes of a document, and features kept.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES, MOST_FEATURES = 500, 2000, 1 << 15, 100_000
#: Log-likelihood ratio from which a feature marks its tokens.
EVIDENCE = 20.0
#: Words whose potentials a worker keeps.
KEPT_WORDS = 300_000


def features(word: str) -> list[int]:
    """Hashes of the word in lower case, its prefixes of 4 to 6 letters and its suffix of 4."""
    w = word.lower()
    names = [f"w:{w}", *(f"p:{w[:k]}" for k in (4, 5, 6) if len(w) > k), *([f"s:{w[-4:]}"] if len(w) > 4 else [])]
    return [xxhash.xxh64_intdigest(f) | 1 for f in names]


def _marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray, begin: float) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of toxic at each token of many chains laid end to end.

    e: log potential of toxic; first: whether a chain begins here; trans: log potentials
    2 x 2; begin: log odds of toxic at the start. The tokens are cut into lanes that run
    side by side; the product of each lane's matrices carries over to the next.
    """
    n = len(e)
    if not n:
        return e, e
    lane = max(1, math.isqrt(n))
    width = -(-n // lane)
    t = np.exp(trans)

    def forward(potential, reset, a, b, c, d, start):
        """Odds r' = potential * (b + d r) / (a + c r), or potential * start where a chain begins."""
        p = np.ones(lane * width)
        p[:n] = potential
        s = np.zeros(lane * width, bool)
        s[:n] = reset
        p, s = p.reshape(width, lane, order="F"), s.reshape(width, lane, order="F")
        any_reset = s.any(axis=1)
        # the lane as a map r -> (k1 + k3 r) / (k0 + k2 r)
        k0, k1, k2, k3 = np.ones(lane), np.zeros(lane), np.zeros(lane), np.ones(lane)
        for i in range(width):
            n0, n2 = a * k0 + c * k1, a * k2 + c * k3
            n1, n3 = p[i] * (b * k0 + d * k1), p[i] * (b * k2 + d * k3)
            if any_reset[i]:
                r = s[i]
                n0, n1, n2, n3 = np.where(r, 1.0, n0), np.where(r, p[i] * start, n1), np.where(r, 0.0, n2), np.where(r, 0.0, n3)
            top = np.maximum(np.maximum(n0, n1), np.maximum(n2, n3))
            k0, k1, k2, k3 = n0 / top, n1 / top, n2 / top, n3 / top
        carry, odds = np.empty(lane), start
        for j, (x0, x1, x2, x3) in enumerate(zip(k0.tolist(), k1.tolist(), k2.tolist(), k3.tolist())):
            carry[j] = odds
            odds = min(max((x1 + x3 * odds) / max(x0 + x2 * odds, 1e-300), 1e-30), 1e30)
        out, odds = np.empty((width, lane)), carry
        for i in range(width):
            odds = p[i] * (b + d * odds) / (a + c * odds)
            if any_reset[i]:
                odds = np.where(s[i], p[i] * start, odds)
            out[i] = odds
        return out.reshape(-1, order="F")[:n]

    potential = np.exp(np.clip(e, -30, 30))
    ahead = forward(potential, first, t[0, 0], t[0, 1], t[1, 0], t[1, 1], math.exp(begin))
    # backwards: q'(1) / q'(0) = (t10 + t11 E q) / (t00 + t01 E q), with E q as the odds that are carried; 1 at a chain's end
    last = np.r_[first[1:], True]
    carried = forward(potential[::-1], last[::-1], t[0, 0], t[1, 0], t[0, 1], t[1, 1], 1.0)[::-1]
    return ahead, carried / potential


def probabilities(e: np.ndarray, first: np.ndarray, trans: np.ndarray, begin: float) -> np.ndarray:
    """Marginal probability of toxic at each token."""
    ahead, behind = _marginals(e, first, trans, begin)
    x = ahead * behind
    return x / (1 + x)


def evidence(p: np.ndarray, chain: np.ndarray, n: int) -> np.ndarray:
    """By chain: logit of the largest marginal, log(1 + sum of marginals), and of their share."""
    top, total, size = np.zeros(n), np.zeros(n), np.bincount(chain, minlength=n)
    np.maximum.at(top, chain, p)
    np.add.at(total, chain, p)
    top = np.clip(top, 1e-7, 1 - 1e-7)
    return np.stack([np.log(top / (1 - top)), np.log1p(total), np.log1p(100 * total / np.maximum(size, 1))], axis=1)


class Field:
    """Weights of a fitted field and of the logistic link from its marginals to a document's score."""

    def __init__(self, weights: dict[int, float], trans: np.ndarray, begin: float, bias: float, link: np.ndarray):
        self.weights, self.trans, self.begin, self.bias, self.link = weights, trans, begin, bias, link

    def potential(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.link[0] + x @ self.link[1:], -30, 30)))


def _ratio(k1: np.ndarray, n1: int, k0: np.ndarray, n0: int) -> np.ndarray:
    """Log-likelihood ratio of features in k1 of n1 toxic and k0 of n0 clean documents; 0 unless four times as frequent in toxic ones."""

    def part(k, n, q):
        return k * np.log(np.maximum(q, 1e-300)) + (n - k) * np.log(np.maximum(1 - q, 1e-300))

    rate = (k1 + k0) / (n1 + n0)
    g = 2 * (part(k1, n1, k1 / n1) + part(k0, n0, k0 / n0) - part(k1, n1, rate) - part(k0, n0, rate))
    return np.where(k1 * n0 > 4 * k0 * n1, g, 0)


def mark_features(own: list[np.ndarray], toxic: list[bool], size: int) -> np.ndarray:
    """Which features are tied to toxic documents; ``own``: each document's distinct features.

    Toxic documents without such a feature are compared with the clean ones again, by
    themselves, until no further feature is found.
    """
    count = lambda x: np.bincount(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64), minlength=size)
    clean, n0 = count([x for x, y in zip(own, toxic) if not y]), len(toxic) - sum(toxic)
    marked = np.zeros(size, bool)
    while n0 and (left := [x for x, y in zip(own, toxic) if y and not marked[x].any()]):
        new = _ratio(count(left), len(left), clean, n0) >= EVIDENCE
        if not new[1:].any():
            break
        marked[1:] |= new[1:]
    return marked


def fit(docs: list[list[str]], toxic: list[bool], rate: float, rounds: int = 60, step: float = 0.3, ridge: float = 1e-3) -> Field:
    """A field from token labels by gradient steps on the log-likelihood, then the link; ``rate``: share of toxic documents to expect.

    A token of a toxic document is labelled toxic if it has a feature tied to toxic documents.
    """
    vocab: dict[str, int] = {}
    ids = [np.array([vocab.setdefault(w, len(vocab)) for w in words], np.int32) for words in docs]
    table = np.zeros((len(vocab) + 1, 5), np.uint64)  # the last row: no feature
    for w, k in vocab.items():
        own = features(w)
        table[k, : len(own)] = own
    hashes, of = np.unique(table, return_inverse=True)
    of = of.reshape(table.shape).astype(np.int32)
    own = [np.unique(of[np.unique(d)]) for d in ids]
    labelled = mark_features(own, toxic, len(hashes))[of].any(axis=1)
    seen = np.bincount(np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int64), minlength=len(hashes))
    kept = np.flatnonzero(seen >= 2)
    kept = kept[kept > 0]
    kept = kept[np.argsort(-seen[kept], kind="stable")][:MOST_FEATURES]
    compact = np.zeros(len(hashes), np.int32)
    compact[kept] = np.arange(1, len(kept) + 1)
    flat = np.concatenate([*ids, np.zeros(0, np.int32)])
    columns = [np.ascontiguousarray(compact[of[:, c]][flat]) for c in range(5)]
    chain = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    first = np.r_[True, chain[1:] != chain[:-1]] if len(chain) else np.zeros(0, bool)
    y = (labelled[flat] & np.array(toxic, bool)[chain]).astype(float)
    w, trans, begin, bias = np.zeros(len(kept) + 1), np.zeros((2, 2)), -2.0, -2.0
    size = w.size + 6
    m, v = np.zeros(size), np.zeros(size)
    inner = np.flatnonzero(~first)
    pair = (2 * y[inner - 1] + y[inner]).astype(int)
    seen_pairs = np.bincount(pair, minlength=4).reshape(2, 2)
    scale = 1 / max(1.0, y.sum())
    for k in range(1, rounds + 1):
        e = bias + sum(w[c] for c in columns)
        ahead, behind = _marginals(e, first, trans, begin)
        x = ahead * behind
        p = x / (1 + x)
        a1, b1, t, pot = ahead[inner - 1], behind[inner], np.exp(trans), np.exp(np.clip(e[inner], -30, 30))
        joint = np.stack([t[0, 0] + 0 * a1, t[0, 1] * pot * b1, a1 * t[1, 0], a1 * t[1, 1] * pot * b1])
        expected = (joint / joint.sum(0)).sum(1).reshape(2, 2)
        miss = y - p
        g = sum(np.bincount(c, miss, w.size) for c in columns)
        g[0] = 0
        grad = np.r_[g, (seen_pairs - expected).ravel(), miss[first].sum(), miss.sum()] * scale - ridge * np.r_[w, trans.ravel(), 0, 0]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = step * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w, trans, begin, bias = w + move[: w.size], trans + move[w.size : w.size + 4].reshape(2, 2), begin + move[-2], bias + move[-1]
        w[0] = 0
    x = evidence(probabilities(bias + sum(w[c] for c in columns), first, trans, begin), chain, len(docs))
    target, odds = np.array(toxic, float), rate / max(1e-9, 1 - rate)
    own = target.mean() / max(1e-9, 1 - target.mean()) if len(target) else 1.0
    weight = np.where(target == 1, odds / max(own, 1e-9), 1.0)
    z, link = np.c_[np.ones(len(x)), x], np.zeros(4)
    for _ in range(50):  # Newton steps with a ridge
        q = 1 / (1 + np.exp(-np.clip(z @ link, -30, 30)))
        h = (z * (weight * q * (1 - q))[:, None]).T @ z + np.diag([1e-6, 0.05, 0.05, 0.05])
        link = link + np.linalg.solve(h, z.T @ (weight * (target - q)) - np.array([0, 0.05, 0.05, 0.05]) * link)
    return Field({int(hashes[k]): float(x) for k, x in zip(kept, w[1:]) if abs(x) > 1e-3}, trans, float(begin), float(bias), link)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", keep: Column | None = None) -> Field | None:
    """A field from at most SAMPLE_TOXIC and SAMPLE_CLEAN labelled documents (whole texts of up to SAMPLE_BYTES), chosen by a hash of the id.

    ``keep``: a condition on the label rows that may be learned from. An id with several
    labels is toxic if one is. Copies, told by their least shingle hash, count once.
    Without documents of both kinds: None.
    """
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    rows = (rows if keep is None else rows.where(keep)).groupBy(F.col(id_col).alias("__id")).agg((F.max(F.col(label_col).cast("int")) > 0).alias("__toxic"))
    counts = {r["__toxic"]: r["count"] for r in rows.groupBy("__toxic").count().collect()}
    if len(counts) < 2:
        return None
    part = F.lit(False)
    for y, most in ((True, SAMPLE_TOXIC), (False, SAMPLE_CLEAN)):
        part = part | ((F.col("__toxic") == y) & (F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(min(1.0, most / counts[y]) * (1 << 30))))
    chosen = rows.where(part).limit(2 * (SAMPLE_TOXIC + SAMPLE_CLEAN))
    texts = docs.where(F.octet_length(text_col) <= SAMPLE_BYTES).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    sample = texts.join(F.broadcast(chosen), "__id").select("__id", "__text", "__toxic").limit(4 * (SAMPLE_TOXIC + SAMPLE_CLEAN)).collect()
    found: dict[tuple, list[str]] = {}
    for r in sorted(sample, key=lambda r: (r["__id"], r["__text"])):
        h = shingle_hashes(r["__text"], 4)
        if len(h):
            found.setdefault((int(h.min()), r["__toxic"]), WORDS.findall(r["__text"]))
    if len({y for _, y in found}) < 2:
        return None
    return fit(list(found.values()), [y for _, y in found], counts[True] / sum(counts.values()))


def tag(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``(id, score double, predicted int, spans array<struct<start, end>>)`` for every row; other columns are not read.

    Spans are runs of words with a marginal over one half, as code points with the end
    exclusive. Null texts count as empty; a text without a word has the score of no
    evidence. Without a field every score is 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for b in chunks(batches, "text", 3 << 20):
            texts = b.column("text").to_pylist()
            n = len(texts)
            if own is None:
                score, spans = np.zeros(n), [[]] * n
            else:
                words = [WORDS.findall(t) for t in texts]
                new = {w for x in words for w in x if w not in known}
                if len(known) + len(new) > KEPT_WORDS:
                    known.clear()
                    new = {w for x in words for w in x}
                known.update((w, own.potential(w)) for w in new)
                sizes = np.fromiter(map(len, words), np.int64, n)
                chain = np.repeat(np.arange(n), sizes)
                e = np.fromiter((known[w] for x in words for w in x), float, len(chain))
                p = probabilities(e, np.r_[True, chain[1:] != chain[:-1]] if len(chain) else np.zeros(0, bool), own.trans, own.begin)
                score, ends = own.scores(evidence(p, chain, n)), np.cumsum(sizes)
                hot = np.bincount(chain, p > 0.5, n)
                spans = [_spans(t, p[j - k : j]) if h else [] for t, h, j, k in zip(texts, hot, ends, sizes)]
            cols = [b.column("id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(cols, ["id", "score", "predicted", "spans"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double, predicted int, spans array<struct<start:long,end:long>>")


def _spans(text: str, p: np.ndarray) -> list[dict]:
    out: list[dict] = []
    last = -2
    for k, m in enumerate(WORDS.finditer(text)):
        if p[k] > 0.5:
            if last == k - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = k
    return out

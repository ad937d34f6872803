import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from strandframe.llm import toxicity


def brute_marginals(e, trans, begin):
    """Sum over all label sequences of one chain."""
    total, toxic = 0.0, np.zeros(len(e))
    for y in itertools.product((0, 1), repeat=len(e)):
        s = begin * y[0] + sum(e[k] * y[k] for k in range(len(e))) + sum(trans[a, b] for a, b in zip(y, y[1:]))
        total += math.exp(s)
        toxic += math.exp(s) * np.array(y)
    return toxic / total


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    for sizes in ([1], [3, 1, 7], [9, 2, 2, 8, 5], [1] * 20):
        e, trans, begin = rng.normal(0, 2, sum(sizes)), rng.normal(0, 1, (2, 2)), -0.7
        first = np.zeros(sum(sizes), bool)
        first[np.cumsum([0, *sizes[:-1]])] = True
        want = np.concatenate([brute_marginals(x, trans, begin) for x in np.split(e, np.cumsum(sizes)[:-1])])
        assert np.allclose(toxicity.probabilities(e, first, trans, begin), want)
    assert len(toxicity.probabilities(np.empty(0), np.zeros(0, bool), np.zeros((2, 2)), 0.0)) == 0


def corpus(n=400):
    rng = random.Random(2)
    clean = ["".join(rng.choices("aeioklmnrst", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(5, 60))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["Zornbad", "quagslur" + rng.choice(["a", "ed", "ing", "ix"])]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_documents_and_spans(spark):
    rows = corpus()
    odd = [(1000, None), (1001, ""), (1002, "12 ..."), (1003, "word " * 50_000 + "zornbad"), (None, "quagslurzz is unseen")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t, _ in rows] + [(*r, 2, "x") for r in odd], "doc_id long, text string, score int, spans string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5000, 1), (7, None), (1, 0)], "doc_id long, toxic int")
    field = toxicity.train(docs, labels, keep=F.col("doc_id") % 4 != 2)
    got = {r.id: r for r in toxicity.tag(docs, field).collect()}
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(i, t, y) for i, t, y in rows if i % 4 == 2]
    assert sum(got[i].predicted == y for i, _, y in held) >= len(held) - 1
    for i, t, y in held:
        found = [t[s.start : s.end].lower() for s in got[i].spans]
        assert all("zornbad" in f or "quagslur" in f for f in found)
    assert [got[k].predicted for k in (1000, 1001, 1002, 1003, None)] == [0, 0, 0, 1, 1]
    assert [(s.start, s.end) for s in got[None].spans] == [(0, 10)]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None
    assert [r.score for r in toxicity.tag(docs, None).collect()] == [0.0, 0.0]
    assert toxicity.tag(docs.limit(0), None).count() == 0

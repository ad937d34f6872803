import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandframe.llm import phrases


def transducer(weights):
    words = sorted({w for g in weights for w in g}, key=str.encode)
    grams = []
    for n in range(1, max(map(len, weights), default=1) + 1):
        own = sorted([words.index(w) for w in g] for g in weights if len(g) == n)
        grams.append((np.array(own, np.int64).reshape(-1, n), np.array([weights[tuple(words[k] for k in g)] for g in own], np.int64)))
    return phrases.build(pa.array(words, pa.string()), grams)


def as_dict(t):
    return phrases._weights(t)


def random_weights(rng, n):
    return {tuple(rng.choice("abcdeé") for _ in range(rng.randint(1, 3))): rng.randint(1, 3) for _ in range(n)}


def test_transducers_hold_their_n_grams_and_are_minimal():
    rng = random.Random(3)
    for n in (0, 1, 5, 60):
        weights = random_weights(rng, n)
        t = transducer(weights)
        assert as_dict(t) == weights
        arcs = list(zip(t.label.tolist(), t.target.tolist(), t.weight.tolist()))
        states = [tuple(arcs[a:b]) for a, b in zip(t.first, t.first[1:])]
        assert len(set(states)) == len(states)
    same_ends = transducer({(a, "x", "y"): 1 for a in "abcd"})
    assert len(same_ends.first) - 1 == 3


def test_union_sums_and_composition_looks_up():
    rng = random.Random(4)
    parts = [random_weights(rng, 30) for _ in range(4)] + [{}]
    whole = Counter()
    for p in parts:
        whole.update(p)
    assert as_dict(phrases.united([transducer(p) for p in parts])) == dict(whole)
    assert as_dict(phrases.united([transducer(p) for p in parts], least=4)) == {k: n for k, n in whole.items() if n >= 4}
    asked = random_weights(rng, 20) | {("zz",): 1, ("a", "zz"): 1}
    assert as_dict(phrases.composed(transducer(asked), transducer(dict(whole)))) == {k: whole[k] for k in asked if k in whole}


def test_ranges_follow_the_order_of_words_and_spread_long_ones():
    ranges = phrases.Ranges([("de", "an", 0), ("en", "be", 0), ("en", "the", 2), ("en", "the", 5), ("en", "to", 0)])
    low, high = ranges.of("en", ["a", "be", "cat", "the", "then", "to"])
    assert low.tolist() == [1, 2, 2, 2, 4, 5] and high.tolist() == [1, 2, 2, 4, 4, 5]
    assert ranges.of("fr", ["a"])[0].tolist() == [5] and ranges.of("cs", ["a"])[0].tolist() == [0]
    words = pa.array(["the", *[f"w{k}" for k in range(50)]])
    pairs = np.array([[0, k] for k in range(1, 51)])
    at = ranges.dealt("en", words, pairs)
    assert set(at) == {2, 3, 4} and ranges.dealt("en", words, np.column_stack([pairs, pairs[:, 1]])).tolist() == at.tolist()


def brute(docs, least, share=50, most=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    usual = {g: a for g, a in f.items() if a >= least}
    for (lang, *g), a in usual.items():
        if len(g) == 1:
            continue
        around = [b for (x, *h), b in usual.items() if x == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(2))]
        if any(100 * b >= share * a for b in around):
            continue
        cuts = [(10**6 * a * a // (f[(lang, *g[:k])] * f[(lang, *g[k:])]), k, f[(lang, *g[:k])], f[(lang, *g[k:])]) for k in range(1, len(g))]
        s, _, left, right = min(cuts)
        out.append((lang, -s, -a, " ".join(g).encode(), left, right))
    rows = []
    for lang in {x[0] for x in out}:
        for rank, (_, s, a, p, left, right) in enumerate(sorted(x for x in out if x[0] == lang)[:most], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(rows)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(11)
    words = ["the", "The", "of", "New", "York", "straße", "\x01", "a\x0bb", " x", "日本", "é", "É", "\U0001f600", "w" * 90]
    some = [(" ".join(rng.choice(words[: rng.choice([5, 14])]) + rng.choice(["", "", "", ",", ".\n", "\t"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "de", None, "und", "zz"])) for _ in range(300)]
    return some + [(None, "en"), ("", "en"), ("...", "en"), ("the the " * 400, "en"), ("one two three", "lone")]


@pytest.mark.parametrize("range_words, filter_bytes, most", [(1 << 21, 1 << 26, 2000), (40, 32, 7)])
def test_collocations_equal_brute_force(spark, docs, range_words, filter_bytes, most):
    frame = spark.createDataFrame([(i, t, x, "n") for i, (t, x) in enumerate(docs)], "doc_id long, text string, lang string, score string").repartition(5)
    got = phrases.collocations(frame, most=most, least=6, range_words=range_words, filter_bytes=filter_bytes)
    assert sorted(map(tuple, got.collect())) == brute(docs, 6, most=most)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["string", "bigint", "string", "bigint", "bigint", "bigint", "bigint", "bigint"]


def test_small_ranges_are_many_and_hold_each_n_gram_once(spark, docs):
    frame = spark.createDataFrame(docs, "text string, lang string")
    table, ranges, _ = phrases.counts(frame, least=6, range_words=40)
    assert len(ranges.keys) > 10 and len({k[:2] for k in ranges.keys}) < len(ranges.keys)
    rows = table.toArrow()
    found = [(lang, g) for i, lang in enumerate(rows.column("lang").to_pylist()) for g in as_dict(phrases._read(rows)[i])]
    assert len(found) == len(set(found)) > 20 and table.count() > 5


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(frame).count() == 0
    assert phrases.collocations(frame.union(spark.createDataFrame([(None, None)], "text string, lang string"))).where(F.lit(True)).count() == 0

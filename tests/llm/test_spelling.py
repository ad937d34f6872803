import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from strandframe.llm import bloom, spelling


def brute_words(docs):
    n = Counter()
    for i, text in docs:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(out)


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    found = {"".join(rng.choice("abß") for _ in range(rng.randint(1, 8))): rng.randint(1, 40) for _ in range(700)}
    return found | {"a" * k: 1 << (9 - k % 4) for k in range(60, 70)} | {"x" * 30 + c: 7 for c in "aÀÿ÷b"} | {"lonely": 3}


@pytest.mark.parametrize("filter_bytes", [1 << 26, 400, 64])
def test_variants_equal_brute_force(spark, words, filter_bytes):
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = spelling.variants(frame, filter_bytes=filter_bytes)
    assert sorted(map(tuple, got.collect())) == brute(words)


def test_long_chains_of_forms_end_at_their_root(spark):
    words = {"abcde" + "f" * k: 3 * 2 ** (24 - k) for k in range(25)}
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert all(r.root == "abcde" and r.form == (r.word[:-1] if r.word != "abcde" else None) for r in got.values())


def test_edits_hash_as_the_words_that_they_make():
    letters = spelling._letters(["banana", "aabbcc"])
    word, at, h = spelling.deletions(letters)
    made = [w[:k] + w[k + 1 :] for w, k in ((["banana", "aabbcc"][i], k) for i, k in zip(word, at))]
    assert len(set(made)) == len(made) == 9 and h.tolist() == spelling.word_hashes(spelling._letters(made)).tolist()
    for word, at, new, h in spelling.replacements(letters):
        made = [["banana", "aabbcc"][i][:at] + chr(c) + ["banana", "aabbcc"][i][at + 1 :] for i, c in zip(word, new)]
        assert h.tolist() == spelling.word_hashes(spelling._letters(made)).tolist()


def test_filters_miss_no_key_and_pass_few_others(spark):
    h = np.random.default_rng(1).integers(0, 1 << 64, 60_000, np.uint64)
    rows = spark.createDataFrame([(k % 2, int(x)) for k, x in enumerate(h[:30_000].view(np.int64))], "shard int, h long")
    filters = bloom.build(rows, bloom.sizes({0: 15_000, 1: 15_000}))
    for shard in (0, 1):
        assert bloom.contains(filters[shard], h[:30_000][shard::2]).all()
        assert bloom.contains(filters[shard], h[30_000:]).mean() < 0.005
    assert sum(b for b in bloom.sizes({0: 10**12, 1: 10**9}, 1 << 20).values()) * 32 <= 1 << 20


def test_groups_of_documents(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["Straße", "strasse", "straßE", "Hello,hello", "HELLO", "naïve", "naive", "word9word", "ab", "Ñandú÷x"]) for _ in range(40))) for i in range(60)]
    docs += [(7, None), (None, "hello " * 5), (8, ""), (9, "hello " * 9), (9, "hello " * 9)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n int, word int")
    assert sorted(map(tuple, spelling.group(frame).collect())) == brute(brute_words(docs))
    assert spelling.group(frame.where("false")).count() == 0

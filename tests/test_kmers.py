"""K-mers in stretches of bases, against counting by hand."""

import random
from collections import Counter

import numpy as np

from strandframe.operators import aggregates


def canonical(kmer):
    return min(kmer, kmer[::-1].translate(str.maketrans("ACGT", "TGCA")))


def test_stretches_hold_each_kmer_once_and_take_little():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ACGTN" if rng.random() < 0.01 else "ACGT") for _ in range(rng.randint(0, 2000))) for _ in range(30)] + ["A" * 900, "ACGT" * 200, ""]
    code = aggregates._CODES[np.frombuffer("\n".join(texts).encode(), np.uint8)]
    for k in (1, 2, 13, 14, 29, 31):
        want = Counter(canonical(t[i : i + k]) for t in texts for i in range(len(t) - k + 1) if "N" not in t[i : i + k])
        blocks, got = {}, {}
        for bucket, block in aggregates._cut(code, k, 7):
            blocks.setdefault(bucket, []).append(block)
        for own in blocks.values():
            known = np.empty(0, np.int64), np.empty(0, np.int64)
            for _ in range(2):  # added to what is known
                known = aggregates._counted(own, k, *known)
            for x, n in zip(*known):
                kmer = "".join("ACGT"[int(x) >> 2 * (k - 1 - j) & 3] for j in range(k))
                assert kmer not in got  # no k-mer in two buckets
                got[kmer] = n / 2
        assert got == want
        if k == 29:
            assert sum(len(x) for own in blocks.values() for x in own) < 2 * sum(want.values())


def test_spectrum_by_hand(spark):
    texts = ["ACGTTACGA", None, "", "NACGTN", "TTTT"]
    count = Counter(canonical(t[i : i + 3]) for t in texts if t for i in range(len(t) - 2) if "N" not in t[i : i + 3])
    want = {n: (sum(x == n for x in count.values()), min(k for k, x in count.items() if x == n), max(k for k, x in count.items() if x == n)) for n in count.values()}
    reads = spark.createDataFrame([(t,) for t in texts], "seq string")
    assert {r.n: (r.kmers, r["first"], r["last"]) for r in aggregates.kmer_spectrum(reads, 3).collect()} == want
    assert {r.kmer: r.n for r in aggregates.kmer_count(reads, 3).collect()} == count

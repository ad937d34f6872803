import random
from fractions import Fraction

import numpy as np
import xxhash

from strandframe.llm import simhash


def brute_fingerprint(text, words=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, fps, radius=4):
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min((rows[j][0] for j in range(len(rows)) if group[j] == g and rows[j][0] is not None), default=None) for g in group]


def texts():
    rng = random.Random(1)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(300)]
    base = [rng.choices(vocab, k=rng.choice([3, 40, 400])) for _ in range(40)]
    out = [" ".join(b) for b in base]
    for b in base[:20]:
        for _ in range(4):
            c = list(b)
            c[rng.randrange(len(c))] = "edit"
            out.append(" ".join(c))
    return [*out, None, "", " \n\t", out[0], out[0], out[0].upper(), "AÄ b", "x"]


def test_components_equal_brute_force(spark):
    rows = [(i // 2 * 3 if i % 17 else None, t) for i, t in enumerate(texts())]
    got = simhash.components(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted((str(i), f, str(c)) for (i, _), f, c in zip(rows, fps, brute_components(rows, fps)))
    assert sorted((str(r.id), int.from_bytes(r.fp, "little"), str(r.component)) for r in got) == want


def test_links_within_radius_are_never_lost(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = {int(c) for c in centre}
    for c in centre.tolist():
        for _ in range(60):
            x = c
            for b in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    frame = spark.createDataFrame([(bytearray(f.to_bytes(8, "little")),) for f in fps], "fp binary")
    for bucket_rows in (1 << 18, 256):
        edges = [(int.from_bytes(r.a, "little"), int.from_bytes(r.b, "little")) for r in simhash.links(frame, 4, 3, bucket_rows=bucket_rows).collect()]
        parent = {f: f for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        want = brute_components([(f, "") for f in fps], fps)
        assert [find(f) for f in fps] == want


def test_one_of_each(spark):
    rows = [(i % 100, t, "s", len(t or ""), 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, source string, n_chars int, digest int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(set(left)) and sum(not (t or "").strip() for _, t in left) == 1
    long = [r[1] for r in rows[:40] if len(r[1].split()) == 400]
    assert all(sum(t == x or (t or "").split()[1:9] == x.split()[1:9] for _, t in left) <= 2 for x in long)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.components(empty).collect() == [] and simhash.one_of_each(empty).collect() == []


def test_spanning_links_equal_brute_force():
    rng, t = np.random.default_rng(4), Fraction(4, 5)
    for _ in range(30):
        stem = rng.integers(0, 2**63, int(rng.integers(1, 60))).astype("<u8")
        sets = [np.unique(np.r_[stem[rng.random(len(stem)) > rng.random() * 0.3], rng.integers(0, 2**63, int(rng.integers(0, 4))).astype("<u8")]) for _ in range(40)]
        parts = [int(rng.integers(0, 60)) for _ in sets]
        want = [(p, "") for p in parts]
        edges = {(i, j) for i in range(40) for j in range(i) if simhash.jaccard_reaches(sets[i], sets[j], t) and len(sets[i])}

        def groups(pairs):
            label = list(parts)
            for i, j in pairs:
                label = [label[j] if x == label[i] else x for x in label]
            return label

        left, right = simhash.spanning_links(sets, parts, t)
        assert all((max(p), min(p)) in edges for p in zip(left, right))
        a, b = groups(zip(left, right)), groups(edges)
        assert all((a[i] == a[j]) == (b[i] == b[j]) for i in range(40) for j in range(i)), want


def test_groups_of_many_blocks(spark):
    rng, t = np.random.default_rng(5), Fraction(4, 5)
    stem = rng.integers(0, 2**63, 50).astype("<u8")
    sets = {k: np.unique(np.r_[stem[rng.random(50) > 0.13], rng.integers(0, 2**63, 2).astype("<u8")]) for k in range(60)}
    nodes = spark.createDataFrame([(k, 0, k % 45, len(v)) for k, v in sets.items()], "node long, grp long, part long, size long")
    table = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in sets.items()], "node long, shingles binary")
    want = None
    for block in (1 << 20, 400, 90):
        label = [k % 45 for k in range(60)]
        for r in simhash._connected(nodes, table, t, block).collect():
            assert simhash.jaccard_reaches(sets[r.a], sets[r.b], t)
            label = [label[r.b] if x == label[r.a] else x for x in label]
        now = [[x == y for y in label] for x in label]
        want = want or now
        assert now == want and 1 < len(set(label)) < 45


def test_links_are_exact(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):  # a text, and one with n words of 300 exchanged: similarities on both sides of 0.8
        words = [f"w{rng.randint(0, 5000)}" for _ in range(300)]
        other = list(words)
        for i in rng.sample(range(300), rng.randint(3, 12)):
            other[i] = "new"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    sets = {i: set(zip(*[t.split()[j:] for j in range(5)])) for i, t in rows}
    want = {i for i in sets if i % 2 == 0 or 5 * len(sets[i] & sets[i - 1]) < 4 * len(sets[i] | sets[i - 1])}
    assert 70 < len(want) < 110
    # 40 texts that are all alike to the first one, and many of them not to each other
    stem = [f"s{i}" for i in range(300)]
    rows.append((1000, " ".join(stem)))
    for k in range(40):
        rows.append((1001 + k, " ".join(f"x{k}" if i in range(k * 7, k * 7 + 48, 12) else w for i, w in enumerate(stem))))
    got = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want | {1000}


def test_pairs_of_a_large_group_come_once(spark):
    """Near copies of one text share most variants; their edges grow with their number, not with that of the variants too."""
    rng = np.random.default_rng(6)
    stem, many = rng.integers(0, 2, 192), {}
    for n in (150, 300):
        bits = np.array([stem ^ (rng.random(192) < 0.04) for _ in range(n)], np.uint8)
        fps = sorted({np.packbits(b).tobytes() for b in bits})
        frame = spark.createDataFrame([(bytearray(f),) for f in fps], "fp binary")
        edges = [tuple(sorted((bytes(r.a), bytes(r.b)))) for r in simhash.links(frame, 40, 12, 3, pairs=True).collect()]
        assert len(edges) == len(set(edges))
        label = {f: f for f in fps}
        for a, b in edges:
            old, new = label[a], label[b]
            label = {f: new if x == old else x for f, x in label.items()}
        assert len(set(label.values())) == 1
        many[n] = len(edges) / len(fps)
    assert max(many.values()) < 20

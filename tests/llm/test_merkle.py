import hashlib
import random

from strandframe.llm import merkle


def text(rng, n):
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 8))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", " ", ". ", ".\n", "\n\n", "\r\n"]) for w in words)


def test_leaves_are_the_text():
    rng = random.Random(3)
    for t in [text(rng, 300), "x" * 5000, "no end " * 900, "", "\n", "a.b!?c\n\n\x85d e", " . "]:
        root, sections = merkle.tree(t)
        sizes = [n for _, parts in sections for _, own in parts for n, _ in own]
        assert sum(sizes) == len(t)
        assert "".join(x for line in t.splitlines(keepends=True) for x in merkle.leaves(line)) == t
        assert "".join(merkle._LINE.findall(t)) == t
        assert merkle.likeness(merkle.fingerprint(t), merkle.fingerprint(t)) == 1.0


def test_edits_are_located():
    rng = random.Random(4)
    a = text(rng, 2000)
    b = a[:5000] + "EDIT" + a[5004:]
    fa, fb = merkle.fingerprint(a), merkle.fingerprint(b)
    assert fa.split("|")[0] != fb.split("|")[0] and merkle.edits(fa, fa) == []
    found = merkle.edits(fa, fb)
    assert any(s <= 5000 and 5004 <= e for s, e in found) and sum(e - s for s, e in found) < 600
    assert 0.9 < merkle.likeness(fa, fb) < 1 and merkle.likeness(fa, merkle.fingerprint(text(rng, 900))) < 0.2


def test_moved_and_deleted_passages_are_edits():
    parts = ["one sentence here.\n", "a second one.\n", "third and last.\n", "more of it.\n"]
    mark = lambda *k: merkle.fingerprint("".join(parts[i] for i in k))
    assert merkle.edits(mark(0, 1, 2, 3), mark(0, 2, 1, 3)) not in ([], None)
    at = len(parts[0])
    assert merkle.edits(mark(0, 1, 2, 3), mark(0, 2, 3)) == [(at, at)]
    assert merkle.edits(mark(0, 2, 3), mark(0, 1, 2, 3)) == [(at, at + len(parts[1]))]
    assert merkle.edits(mark(0), mark()) == [(0, 0)] and merkle.edits(mark(), mark(0)) == [(0, at)]


def test_edits_cover_all_that_differs():
    rng = random.Random(6)
    for _ in range(60):
        a = text(rng, rng.choice([5, 60, 400]))
        cut = sorted(rng.choices(range(len(a) + 1), k=4))
        b = rng.choice([a[: cut[0]] + "NEW. " + a[cut[1] :], a[: cut[0]] + a[cut[1] : cut[2]] + a[cut[3] :], a[: cut[0]] + a[cut[2] : cut[3]] + a[cut[1] : cut[2]] + a[cut[3] :]])
        found = merkle.edits(merkle.fingerprint(a), merkle.fingerprint(b))
        assert (found == []) == (a == b)
        at, rest, pieces = 0, a, []
        for s, e in found:  # what lies between the edits comes from the first text, in order
            assert at <= s <= e <= len(b)
            pieces.append(b[at:s])
            at = e
        for x in [*pieces, b[at:]]:
            assert x in rest
            rest = rest[rest.index(x) + len(x) :]


def test_texts_without_spaces_have_leaves():
    rng = random.Random(7)
    a = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(3200))
    b = a[:1600] + "X" + a[1601:]
    fa, fb = merkle.fingerprint(a), merkle.fingerprint(b)
    assert merkle.likeness(fa, fb) > 0.8 and sum(e - s for s, e in merkle.edits(fa, fb)) < 800
    assert max(map(len, merkle.leaves(a))) <= 2 * merkle.LEAF_CHARS and "".join(merkle.leaves("x" * 5000)) == "x" * 5000
    line = "a b\u2028c d"
    assert len(merkle.tree(line)[1][0][1]) == 1 and len(merkle.tree(line + "\nx")[1][0][1]) == 2


def brute(rows):
    """The next in descending id of unique ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + n[:h]
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), merkle.fingerprint(t), merkle.fingerprint(e), merkle.likeness(merkle.fingerprint(t), merkle.fingerprint(e)), merkle.likeness(merkle.fingerprint(t), merkle.fingerprint(n)))
    return out


def test_compare_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i * 7 - 300, text(rng, rng.choice([1, 20, 200]))) for i in range(150)]
    rows[3], rows[4], rows[9] = (rows[3][0], None), (rows[4][0], ""), (rows[9][0], rows[10][1])
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, part int").repartition(5)
    want = brute(rows)
    for size in (20_000, 20):
        dealt = merkle.with_next(docs, rows_per_range=size)
        assert dealt.count() > 150
    got = merkle.compare(docs).collect()
    assert {r.id: tuple(r)[1:7] for r in got} == want and len(got) == 150


def test_ties_nulls_and_small_tables(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "other text"), (None, "none"), (None, None), (1, "")]
    got = merkle.compare(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(str(r.id) for r in got) == sorted(str(i) for i, _ in rows)
    assert len({r.fingerprint for r in got if r.n_chars == 7}) == 1
    one = merkle.compare(spark.createDataFrame([(3, "only one")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"onlyonly").hexdigest()
    assert merkle.compare(spark.createDataFrame([], "doc_id long, text string")).count() == 0

import random
from fractions import Fraction

import numpy as np
import pytest

from strandframe.llm import mixing


def test_every_block_meets_its_window_and_no_share_is_a_block_off():
    rng = random.Random(6)
    for _ in range(20):
        weights = {f"s{i}": rng.random() + 0.01 for i in range(rng.randint(1, 12))}
        shares = mixing.quanta(weights, 256)
        assert sum(shares.values()) == 256
        slots = mixing.period_slots(shares, 256)
        owner = {}
        for s, at in slots.items():
            release, due = mixing.windows(np.arange(shares[s]), shares[s], 256)
            assert (release <= at).all() and (at < due).all()
            owner.update((int(t), s) for t in at)
        assert sorted(owner) == list(range(256))
        got = dict.fromkeys(shares, 0)
        for t in range(256):
            got[owner[t]] += 1
            assert all(abs(n - Fraction(shares[s] * (t + 1), 256)) < 1 for s, n in got.items())


def test_plan_covers_all_blocks():
    blocks = {"a": 1000, "b": 10, "c": 0, "d": 333}
    phases = mixing.plan(blocks, {"a": 1.0, "b": 5.0, "c": 1.0, "d": 2.0}, 64)
    assert "c" not in phases[0].shares and len(phases) <= 3
    ends = [*(p.start for p in phases[1:]), None]
    for s, n in blocks.items():
        done = sum((e - p.start) // 64 * p.shares[s] for p, e in zip(phases, ends) if s in p.shares and e is not None)
        assert n == 0 or done >= n or s in phases[-1].shares


def test_mix_keeps_rows_and_deviation(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randint(0, 300), "hot" if i % 3 else f"s{i % 4}", 7) for i in range(3000)] + [(None, None, None, 7), (5, "", "s1", 7), (5, "", "s1", 7), (1, "y" * 50_000, "s2", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, slot int")
    got = mixing.mix(docs, block_bytes=512, period=64).collect()
    assert sorted(str((r.doc_id, r.text, r.source)) for r in got) == sorted(str(r[:3]) for r in rows)
    assert all(r.release >= 0 and r.deadline > r.release for r in got)
    blocks = {}
    for r in got:
        blocks.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(b) == 1 for b in blocks.values())
    per = {}
    for r in got:
        per.setdefault((r.source, r.block), set()).add(r.slot)
    assert all(len(s) == 1 for s in per.values())
    ordered = mixing.in_order(docs, block_bytes=512, period=64)
    assert ordered.columns == docs.columns and sorted(map(str, ordered.collect())) == sorted(map(str, docs.collect()))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_bad_weights(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        mixing.mix(docs, {"other": 1.0})


def test_deviation_from_the_given_weights_over_many_periods():
    weights = {f"s{i}": (1000.0 * (i + 1)) ** 0.5 for i in range(20)} | {"rare": 0.001}
    total = sum(Fraction(w) for w in weights.values())
    blocks = {s: int(Fraction(w) / total * 64 * 300) + 1 for s, w in weights.items()} | {"rare": 2}
    phase = mixing.plan(blocks, weights, 64)[0]
    owner = {int(t): s for s, at in phase.slots.items() for t in at}
    slots = len(owner)
    assert slots >= 64 * 200 and sorted(owner) == list(range(slots))
    got = dict.fromkeys(weights, 0)
    for t in range(slots):
        got[owner[t]] += 1
        if t % 37 == 0 or t == slots - 1:
            assert all(abs(n - Fraction(weights[s]) / total * (t + 1)) < 1 for s, n in got.items())


def test_windows_of_rows_follow_the_given_weights(spark):
    docs = spark.createDataFrame([(i, "x" * 99, "a" if i % 4 else "b") for i in range(4000)], "doc_id long, text string, source string")
    weights = {"a": 2.0**0.5, "b": 1.0}
    total = sum(map(Fraction, weights.values()))  # b ends after 1,300 blocks of a
    for r in mixing.mix(docs, weights, block_bytes=100, period=8).where("source = 'a'").orderBy("slot").limit(1300).collect():
        w = Fraction(weights["a"]) / total
        assert r.release == r.block // w and r.deadline == -(-(r.block + 1) // w) and r.release <= r.slot < r.deadline


def test_clashing_names_and_blocks_that_grow(spark, monkeypatch):
    names = ["__row", "__size", "__hash", "__part", "__source", "row", "size", "hash", "part", "at", "c0"]
    rows = [(i, "x" * (i % 90), "ab"[i % 3 == 0], *range(len(names))) for i in range(500)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 40)
    got = mixing.mix(docs, block_bytes=16, period=8)
    assert got.columns == [*docs.columns, "block", "release", "deadline", "slot", "block_offset"]
    found = got.collect()
    assert sorted(tuple(r)[: len(docs.columns)] for r in found) == sorted(rows) and len({(r.source, r.block) for r in found}) <= 42
    ordered = mixing.in_order(docs, block_bytes=16, period=8)
    assert ordered.columns == docs.columns and sorted(map(tuple, ordered.collect())) == sorted(rows)


def test_no_share_is_a_block_off_over_a_million_blocks():
    weights = {"a": 2.0**0.5, "b": 1.0, "c": 0.1, "d": 3e-5}
    unit = {s: Fraction(w) for s, w in weights.items()}
    total = sum(unit.values())
    n = 1_000_000
    scale = 2**60
    slots = mixing.schedule({s: int(w * scale) for s, w in unit.items()}, n)
    assert sum(map(len, slots.values())) == n
    share = {s: Fraction(int(w * scale), sum(int(x * scale) for x in unit.values())) for s, w in unit.items()}
    for s, at in slots.items():
        for j in [*range(0, len(at), 997), len(at) - 1]:  # what a source has got just before and after a block of its own
            assert abs(j - share[s] * int(at[j])) < 1 and abs(j + 1 - share[s] * (int(at[j]) + 1)) < 1
    assert total


def test_sums_before_in_two_levels(spark):
    from strandframe.llm.common import sums_before

    rows = [(k % 2, k // 2, k * k % 7) for k in range(301)]
    got = sums_before(spark.createDataFrame(rows, "k int, at long, v long"), ["k"], "at", "v", "before", width=10)
    assert sorted(map(tuple, got.select("k", "at", "v", "before").collect())) == sorted((k, at, v, sum(y for j, i, y in rows if j == k and i < at)) for k, at, v in rows)

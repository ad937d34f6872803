"""The registered queries of the subpackage on the smallest given tables, held against their contracts."""

import base64
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

from strandframe.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def docs():
    rows = duckdb.execute(f"SELECT doc_id, text, lang, source FROM read_parquet('{SF}/documents.parquet') ORDER BY doc_id").fetchall()
    return {r[0]: r[1:] for r in rows}


def rows(spark, name):
    return queries.queries()[name](spark, SF).collect()


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_op1(spark, docs):
    got = rows(spark, "op1_toxicity")
    assert sorted(r.doc_id for r in got) == sorted(docs) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_op2(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op2_merkle")}
    order = sorted(docs, reverse=True)
    assert set(got) == set(docs)
    for i, j in zip(order, [*order[1:], order[0]]):
        t, n = docs[i][0] or "", docs[j][0] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + n[:h]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and (got[i].fingerprint == got[i].edited_fingerprint) == (t == e) and 0 <= got[i].near_next <= 1


def test_op3(spark, docs):
    got = rows(spark, "op3_sharding")
    slots = defaultdict(list)
    for r in got:
        raw = (docs[r.doc_id][0] or "").encode()
        assert (r.size, r.text_crc32) == (8 + (len(raw) if docs[r.doc_id][0] is not None else 0), zlib.crc32(raw)) and 0 <= r.shard < 24 and r.law == "key" and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert len(got) == len(docs) and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_op4(spark):
    pages = dict(duckdb.execute(f"SELECT page_id, html FROM read_parquet('{SF}/pages.parquet')").fetchall())
    best = {}
    for i, h in pages.items():
        best[h or ""] = max(i, best.get(h or "", i))
    for r in rows(spark, "op4_warc"):
        raw = (pages.pop(r.page_id) or "").encode()
        top = best[raw.decode()]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *(("response", None) if top == r.page_id else ("revisit", top)))
    assert not pages


def test_op5(spark, docs):
    from .test_pii import brute

    kinds = ["email", "ip", "card", "phone"]
    got = {r.doc_id: r for r in rows(spark, "op5_pii")}
    assert set(got) == set(docs)
    for i, (t, *_) in docs.items():
        base = sorted(brute(t or ""), key=lambda s: (kinds.index(s[0]), s[1]))
        mark = ",".join(":".join(map(str, s)) for s in base)
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in base) for k in kinds]
        assert got[i].base_sha256 == hashlib.sha256(mark.encode()).hexdigest() and got[i].spans.startswith(mark)


def test_op6(spark, docs):
    got = rows(spark, "op6_langid")
    known = {v[1] for i, v in docs.items() if v[1] and not held(i)}
    assert len(got) == len(docs) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id][0] or "")) and r.lang_pred in known | {"und"} for r in got)
    told = [r.lang_pred == docs[r.doc_id][1] for r in got if r.held_out and docs[r.doc_id][1]]
    assert sum(told) >= 0.9 * len(told)


def test_op7(spark, docs):
    got = rows(spark, "op7_media")
    assert len(got) == len(docs)
    for r in got:
        raw = (docs[r.doc_id][0] or "").encode()
        padded = raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))


def test_op8(spark, docs):
    got = rows(spark, "op8_mixing")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    places = Counter((r.slot, r.block_offset) for r in got)
    assert max(places.values()) == 1 and len({(r.slot, r.source) for r in got}) == len({r.slot for r in got})
    assert all(r.release <= r.deadline for r in got)


def test_op9(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op9_simhash")}
    fps = {}
    for i, (t, *_) in docs.items():
        w = "".join(c.lower() if c.isascii() else c for c in t or "").replace("\v", " ").replace("\f", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
        w = [x for x in w if x]
        grams = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert {i: f"{f:016x}" for i, f in fps.items()} == {i: r.fingerprint for i, r in got.items()}
    group = {i: i for i in fps}
    for i in fps:
        for j in fps:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= 4 and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    assert all(got[i].component_id == group[i] for i in fps)


def test_op10(spark, docs):
    got = rows(spark, "op10_packing")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for x in (*pieces.values(), *sequences.values()):
        at = 0
        for begin, n, *_ in sorted(x):
            assert begin == at
            at += n
        assert at == x[0][2] if len(x[0]) == 3 else at <= 2048


def test_op11(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = {i: len(whole.encode(t or "", add_special_tokens=False)) for i, (t, *_) in docs.items()}
    got = rows(spark, "op11_tokens")
    assert sorted(got) == sorted((i, len((docs[i][0] or "").encode()), k, k > 2048) for i, k in n.items())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    from .. import oracle

    assert oracle.difference(spark, oracle.connect(SF), SF, queries.queries()[name], queries.oracle_sql()[name]) is None

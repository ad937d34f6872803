import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandframe.llm import mixing, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "plain words, it's 12.5% done_now  two  spaces\n\n\tend ", "don't we'll I'VE 's", "a" * 5000, "Äpfel & ñandú éà ½ ² ³ x²", "日本語 テキスト١٢٣ Ⅷ", "<|endoftext|> in a text", "tab\x1cfs\x85nel\xa0nbsp em", "é combining \U0001f600 emoji‍", "“quoted” – dash… €5", "word " * 6000, "x\r\ny", "__init__ snake_case ___", " ­ soft", "\u0000 nul",
]


def test_ids_equal_the_tokenizer():
    rng = random.Random(5)
    alphabet = "ab'st \n\t.,_0189éß²½ªº€— \x1d 漢"
    texts = [t for t in TEXTS if t is not None] + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(2000)]
    encode = packing.Encoder(PATH)
    plain = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encode(texts) == want and encode(texts[::-1]) == want[::-1]


def brute_first_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        k = next((i for i, r in enumerate(room) if r >= s), len(room))
        if k == len(room):
            room.append(capacity)
        out.append((k, capacity - room[k]))
        room[k] -= s
    return out


def test_tournament_tree_equals_first_fit():
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 300):
        sizes = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
        assert list(zip(*packing.first_fit_decreasing(sizes, 100))) == brute_first_fit(sizes, 100)
    with pytest.raises(ValueError):
        packing.first_fit_decreasing([101], 100)


def test_every_id_lies_in_one_piece(spark):
    rows = [(i // 2 if i else None, t, i) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack_documents(docs, PATH, 128).toPandas()
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for i, t, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(str(i), s, len(p), zlib.crc32(np.array(p, "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 128) for p in [ids[s : s + 128]]]
    ids = ["None" if x != x else str(int(x)) for x in got.id]
    assert sorted(zip(ids, got.start, got.length, got.ids_crc32, got.doc_tokens)) == sorted(want)
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert list(seq.offset) == [0, *seq.length.cumsum()[:-1]] and seq.length.sum() <= 128
    assert got.length.sum() / 128 / got.sequence_id.nunique() > 0.97


def test_groups_are_packed_alone(spark):
    parts = spark.range(3000).selectExpr("id", "id % 700 + 1 AS length", "7 AS start")
    got = packing.pack(parts, 2048, group_pieces=500).toPandas()
    assert len(got) == 3000 and (got.sequence_id.to_numpy() >> 32).max() == 5
    assert got.groupby("sequence_id").length.sum().max() <= 2048


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_stretches_of_sequences_hold_the_shares_of_the_mix(spark):
    rng = random.Random(7)
    words = "an order of words that the mix deals out to blocks".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(5, 30))), "abc"[0 if i < 3000 else 1 if i < 3900 else 2]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").orderBy("doc_id")
    weights, block = {"a": 3.0, "b": 0.9, "c": 0.1}, 512
    mixed = mixing.mix(docs, weights, block_bytes=block, period=64)
    parts = packing.pieces(mixed, PATH, 128, place=F.struct("slot", "block_offset"))
    got = packing.pack(parts, 128, group_pieces=200).withColumn("stretch", F.expr("sequence_id >> 32")).collect()
    assert len({r.id for r in got}) == 4000
    slot = {r.doc_id: (r.slot, r.block_offset) for r in mixed.collect()}
    size = {i: len(t) + 1 for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    by = {}
    for r in got:
        by.setdefault(r.stretch, set()).add(r.id)
    assert sorted(by) == list(range(-(-len(got) // 200)))
    for k in range(len(by) - 1):
        assert max(slot[i] for i in by[k]) <= min(slot[i] for i in by[k + 1])
    for k in range(min(10, len(by) - 2)):  # all sources still take part
        total = sum(size[i] for i in by[k])
        for s, w in weights.items():  # a block at either end, cut by the stretch, and a document's overhang
            assert abs(sum(size[i] for i in by[k] if source[i] == s) - w / 4 * total) <= 2 * block + 200

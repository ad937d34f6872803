import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandframe.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["'s", "'ll", "!!'s", "<|endoftext|>", "<|END", "OFTEXT|>", "é", "̖́", "İ", "ẞ", "각", "각", "한국", " ", " ", "\x1c", "\r\n", "12.5", "x,y.z", "A.", "é.", "😂😂😂", "\U0001f1fa\U0001f1f8", "日本語", "ﬁ", "Å", "क़", "...", "'", "\x00", "hello", "World,", "\U00016d63\U00016d67", "ाা"]


def words(rng, n):
    return "".join(rng.choice(ODD) + rng.choice(["", "", " ", "\n"]) if rng.random() < 0.5 else "".join(rng.choice("abcdetn") for _ in range(rng.randint(1, 9))) + rng.choice(["", " ", ", "]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    out = [None, "", " ", "<|startoftext|><|endoftext|>", "the " * 3000, "a" * 5000, "!" * 4000, "'s" * 3000, "😂" * 3000, "́" * 2000, "ab" * 2500 + "<|endoftext|>" + "thinkbigsundaywithmarsha" * 90, "1" * 3000, "각" * 900]
    return out + ["".join(rng.choice("etaoin") for _ in range(4000))] + [words(rng, rng.choice([3, 40, 900])) for _ in range(60)]


@pytest.fixture(scope="module")
def whole(texts):
    t = Tokenizer.from_file(PATH)
    return [len(t.encode(x or "", add_special_tokens=False)) for x in texts]


@pytest.mark.parametrize("chunk, overlap", [(64, 60), (200, 120), (1 << 15, 512)])
def test_counts_equal_those_of_whole_texts(spark, texts, whole, chunk, overlap):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = tokens.count_tokens(docs, PATH, 100, chunk_chars=chunk, overlap_chars=overlap).collect()
    assert sorted((r.id, r.n_tokens, r.n_bytes, r.over_limit) for r in got) == [(i, n, len((t or "").encode()), n > 100) for i, (t, n) in enumerate(zip(texts, whole))]


def test_most_places_are_found_without_widening(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts) if len(t or "") > 400], "row long, text string")
    encoded = tokens._encoded(tokens._cut(docs, 300, 120), PATH, 120).cache()
    spliced = tokens._spliced(encoded, PATH)
    found, all_of_them = spliced.where("extra is not null").count(), encoded.where("not last").count()
    assert all_of_them > 100 and found > 0.8 * all_of_them and spliced.count() == all_of_them


def test_boundaries_inside_a_word_are_found_or_the_overlap_widens(spark):
    t, c = Tokenizer.from_file(PATH), tokens.Counter(PATH)
    text = "internationalizationofthesunday" * 40
    left, right = c.tokens([text[:700]])[0], c.tokens([text[300:]])[0]
    right[:, 1:3] += 300
    i, j = tokens.common_boundary(left, right, 320, 680, text[300:700], 300)
    assert left[i, 3] == 0 and left[:i, 0].tolist() + right[j:, 0].tolist() == t.encode(text, add_special_tokens=False).ids
    assert tokens.common_boundary(left, right, 699, 699, text[300:700], 300) is None


def test_repeated_rows_string_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("a", "to be " * 300), ("a", "to be " * 300), (None, "to be")], "doc_id string, text string")
    got = tokens.count_tokens(docs, PATH, chunk_chars=100, overlap_chars=50).select("id", "n_tokens").collect()
    assert sorted(got, key=str) == sorted([("a", 600), ("a", 600), (None, 2)], key=str)
    assert tokens.count_tokens(docs.where(F.lit(False)), PATH).count() == 0


def test_other_vocabularies_count_whole_texts(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["", "Hello there", "a b  c" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.id: r.n_tokens for r in tokens.count_tokens(docs, path, chunk_chars=10, overlap_chars=5).collect()}
    assert got == {i: len(x) for i, x in enumerate(sentencepiece.SentencePieceProcessor(model_file=path).encode(texts))}
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r.id: r.n_tokens for r in tokens.count_tokens(docs, path, chunk_chars=10, overlap_chars=5).collect()}
    assert got == {i: len(Tokenizer.from_file(path).encode(x, add_special_tokens=False)) for i, x in enumerate(texts)}

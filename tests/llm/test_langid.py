import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strandframe.llm import langid


def brute_log_p(train: Counter, word: str, other: Counter) -> float:
    """Interpolated Kneser-Ney by dictionaries of strings."""
    counts = defaultdict(Counter)
    for w, k in train.items():
        s = f" {w} "
        for n in range(1, langid.ORDER + 1):
            for i in range(max(1, n - 1), len(s)):
                counts[n][s[i - n + 1 : i + 1]] += k
    kn = {}
    for n in range(langid.ORDER, 0, -1):
        if n == langid.ORDER:
            kn[n] = dict(counts[n])
        else:
            before = Counter(g[1:] for g in counts[n + 1])
            first = lambda g: n > 1 and g[0] == " "
            kn[n] = {g: c if first(g) else max(1, before[g]) for g, c in counts[n].items()}
    d = {}
    for n, table in kn.items():
        once, twice = sum(c == 1 for c in table.values()), sum(c == 2 for c in table.values())
        d[n] = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
    floor = -math.log(max(len(set("".join(t)) | {" "}) for t in (train, other)) + 1)

    def p(gram):
        n = len(gram)
        if n == 0:
            return math.exp(floor)
        own = {g: c for g, c in kn[n].items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        total = sum(own.values())
        return max(own.get(gram, 0) - d[n], 0) / total + d[n] * len(own) / total * p(gram[1:])

    s = f" {word} "
    return sum(math.log(p(s[max(0, i - langid.ORDER + 1) : i + 1])) for i in range(1, len(s)))


def test_scores_equal_kneser_ney_by_hand():
    a = Counter({"banana": 3, "bandana": 1, "ananas": 2, "ab": 1, "b": 2, "nab": 1})
    b = Counter({"zebra": 2, "bazar": 1, "azur": 1, "z": 1})
    model = langid.Model({"a": a, "b": b})
    words = ["banana", "band", "zebra", "q", "anan", "bazan"]
    got = model.score_words(words)
    for k, w in enumerate(words):
        assert got[k, 0] == pytest.approx(brute_log_p(a, w, b)) and got[k, 1] == pytest.approx(brute_log_p(b, w, a))


def make(spark):
    rng = random.Random(4)
    parts = {"xx": ["ka", "to", "mi", "re"], "yy": ["sch", "und", "eit", "ge"]}
    word = {k: lambda p=p: "".join(rng.choices(p, k=rng.randint(1, 4))) for k, p in parts.items()}
    rows = [(i, " ".join(word[k]() for _ in range(rng.randint(3, 60))), k) for i in range(300) for k in parts]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_identify(spark):
    rows, docs = make(spark)
    model = langid.train(docs, keep=F.col("doc_id") % 4 != 2)
    odd = [(900, None, None), (901, "", "xx"), (902, "12 % --", "yy"), (903, "kato " * 40000, "xx"), (904, "qqwzx vvjjq xxzzq qzqz wvwv jjqq", "xx")]
    frame = spark.createDataFrame([(*r, 1.0, 2) for r in rows + odd], "doc_id long, text string, lang string, score double, rejected int")
    out = langid.identify(frame, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    got = {(r.doc_id, r.lang): r for r in out.collect()}
    held = [r for r in rows if r[0] % 4 == 2]
    assert sum(got[r[0], r[2]].lang_pred == r[2] for r in held) == len(held)
    assert sum(got[r[0], r[2]].rejected for r in rows) <= 2
    for key in ((900, None), (901, "xx"), (902, "yy")):
        assert (got[key].lang_pred, got[key].score, got[key].rejected) == ("und", 0.0, True)
    assert got[903, "xx"].lang_pred == "xx" and not got[903, "xx"].rejected
    assert got[904, "xx"].rejected and all(0 <= r.score <= 1 for r in got.values())
    kept = langid.identify(frame, model, prefix="__").select(frame.columns)
    assert sorted(kept.collect(), key=str) == sorted(frame.collect(), key=str)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, "1 2", "en")], "doc_id long, text string, lang string")
    assert langid.train(docs) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(docs.limit(0), None).count() == 0


def test_numerals_are_no_letters(spark):
    assert langid.words_of("½ ² Ⅷ x² ab_c 9") == ["x", "ab", "c"]
    rows = [(i, t, lang) for i in range(40) for t, lang in ((f"the house and the tree {i}", "en"), (f"das haus und der baum {i}", "de"))] + [(99, "½ ²", None), (98, "Ⅷ", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(docs, langid.train(docs)).collect()}
    assert (got[99].lang_pred, got[99].score) == ("und", 0.0) and got[98].lang_pred == "und" and got[3].lang_pred in ("de", "en")


def test_many_languages_each_get_a_model(spark):
    rows = [(k, f"{chr(97 + k % 26)}{chr(97 + k // 26)}k word of this language", f"l{k:03d}") for k in range(260)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 260


def test_languages_of_long_texts_only_are_learned(spark):
    long = [(k, "la maison est dans la rue et le chat dort " * (1700 + k), "fr") for k in range(12)]
    rows = long + [(100 + k, f"the house is in the street and the cat sleeps {'x' * (k % 7)} again", "en") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample_docs=10)
    assert model.languages == ["en", "fr"] and all(len(t.encode()) > langid.SAMPLE_BYTES for _, t, _ in long)
    got = langid.identify(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_tables_hold_a_language_s_own_n_grams_only():
    model = langid.Model({"a": Counter({"banana": 3}), "b": Counter({w: 1 for w in ("zebra", "cabbage", "house", "garden")})})
    assert len(model.tables[0][4][0]) < len(model.tables[1][4][0]) / 2


def test_new_words_are_scored_in_slices():
    """The tables of n-grams beside new words are bounded, however many a text brings."""
    model, sizes = langid.Model({"a": Counter({"banana": 3, "ananas": 2}), "b": Counter({"zebra": 2, "azur": 1})}), []
    whole = model.score_words
    model.score_words = lambda words: sizes.append(len(words)) or whole(words)
    words = [f"w{'abcdefghij'[i % 10]}{chr(97 + i // 10 % 26)}{chr(97 + i // 260)}" for i in range(6000)]
    (total, n), = langid.Scorer(model)([words])
    assert max(sizes) <= 4096 and sum(sizes) == len(set(words))
    assert total == pytest.approx(whole(words).sum(0)) and n == sum(map(len, words)) + 6000

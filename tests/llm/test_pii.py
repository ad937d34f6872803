import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from strandframe.llm import pii, queries

SF = os.environ.get("TEST_PII_DIR", "/root/testdata/sf0.1")


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0


def brute(text):
    """The four patterns as they are written."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(7)
    for alphabet in ("a@.b-_ 1", "0123456789. ", "0 1-2+3(4)5.6789", "+1 (555)-0.", "@a.é1٣", "12.255.0"):
        for _ in range(3000):
            t = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
            assert pii.base_spans(t) == brute(t), t
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111 4", "378282246310005", "+1 (415) 555-2671", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "0001.2.3.4"]
    for a in cards:
        for b in cards:
            assert pii.base_spans(a + b) == brute(a + b) and pii.base_spans(f"x {a} y{b}") == brute(f"x {a} y{b}")
    assert pii.base_spans("1" * 200_000 + ".1" * 2 + "a" * 200_000) == []


def test_learned_patterns_find_unseen_values(spark):
    rng = random.Random(1)
    ip = lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))
    rows = [(i, f"word login from {ip()} ok then") for i in range(400)]
    rows += [(1000 + i, f"order number 2024{i:05d} was sent") for i in range(400)]
    rows += [(2000, "word login from 999.888.777.666 ok then"), (2001, "login from here"), (2002, None), (2003, ""), (2004, "x" * 100_000 + " 1" * 5000)]
    docs = spark.createDataFrame([(*r, 5, "s") for r in rows], "doc_id long, text string, n_chars int, spans string")
    patterns = pii.learn(docs)
    names = {r["pattern"] for r in patterns.collect()}
    assert "< from " in names and not any("order" in p or "number" in p for p in names)
    got = {r.id: r for r in pii.find(docs, patterns).collect()}
    assert got[2000].spans == "id:16:31" and got[2000].n_found == 1 and got[2000].n_ip == 0
    assert got[0].spans == "ip:16:%d" % rows[0][1].index(" ok") and got[0].n_ip == 1
    for i, t in rows:
        mark = ",".join(":".join(map(str, s)) for s in sorted(brute(t or ""), key=lambda s: (pii.KINDS.index(s[0]), s[1])))
        assert got[i].base_sha256 == hashlib.sha256(mark.encode()).hexdigest()
    clean = {r.doc_id: r for r in pii.redact(docs, patterns).collect()}
    assert clean[2000].text == "word login from <id> ok then" and clean[2000].n_chars == len(clean[2000].text)
    assert clean[0].text == "word login from <ip> ok then" and clean[1000].text == rows[400][1] and clean[2002].text is None
    assert pii.redact(docs, patterns).columns == docs.columns and clean[1000].n_chars == 5
    # patterns that are too many to broadcast are joined, with the same result
    assert sorted(pii.find(docs, patterns, most=0).collect(), key=str) == sorted(got.values(), key=str)
    assert sorted(pii.redact(docs, patterns, most=0).collect(), key=str) == sorted(clean.values(), key=str)


def wilson(p, n):
    z = pii.Z
    return (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)


def test_rounds_carry_confidence_to_further_patterns(spark):
    """Keys in a trusted form lift a context with one seed of its own, which then finds values of another form."""
    rng = random.Random(3)
    key = lambda: "a7" + "".join(rng.choice("0123456789abcdef") for _ in range(38))
    valid, wrong = [key() for _ in range(3000)], [key().upper() for _ in range(60)]
    rows = [f"paid {d} today" for d in valid] + [f"account {d} open" for d in wrong] + [f"account {valid[0]} open", "account AB-77 open"]
    rows += [f"page 20{k:08d} of" for k in range(900)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = pii.learn(docs)
    patterns = {r["pattern"]: r["confidence"] for r in found.collect()}
    total = len(valid) + len(wrong)
    form = wilson(len(valid) / total, total)
    context = wilson((1 + len(wrong) * form) / (len(wrong) + 2), len(wrong) + 2)
    assert form >= pii.CONFIDENCE and context >= pii.CONFIDENCE and not any("page" in p for p in patterns)
    # the context says yes to the numbers in turn
    assert patterns["hex x40"] > form and patterns["< account "] == pytest.approx(context, abs=1e-3)
    got = {r.id for r in pii.find(docs, found).where("n_found > 0").collect()}
    last = len(valid) + len(wrong) + 1
    assert last in got and sum(len(valid) <= i < len(valid) + len(wrong) for i in got) >= 55 and max(got) == last


def test_numbers_that_fail_their_check_are_no_evidence_for_their_form(spark):
    rng = random.Random(5)
    numbers = [str(rng.randrange(10**15, 10**16)) for _ in range(3000)]
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    rows = [f"{w} {d} {w}" for w, d in zip(words, (d for d in numbers if luhn(d)))] + [f"{w} {d} {w}" for w, d in zip(words, [d for d in numbers if not luhn(d)][:5])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = pii.learn(docs)
    assert found.where("pattern = 'numeric 9{16}'").count() == 1 and pii.find(docs, found).where("n_found > 0").count() == 0


def test_contexts_carry_values_of_other_forms_and_few_seeds_prove_nothing(spark):
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [f'set token = "{digits(30)}a7" now' for _ in range(40)] + ['set TOKEN = "QX-77.z" now', "set it = 5 now"]
    rows += [f"ask {rng.randint(1, 255)}.4.5.6 rare" for _ in range(5)] + ["ask 77-x rare"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = pii.learn(docs)
    assert {'<< token = "', '< = "'} <= {r["pattern"] for r in found.collect()} and not any("ask" in r["pattern"] for r in found.collect())
    spans = {r.id: r.spans for r in pii.find(docs, found).collect()}
    assert spans[40] == "id:13:20" and spans[41] == "" and spans[47] == ""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_patterns_of_a_given_table_find_its_keys(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    patterns = pii.learn(docs)
    assert patterns.where("""pattern = '<< token = "'""").count() == 1
    rows = pii.find(docs, patterns).join(docs.select("doc_id", "text"), F.col("id") == F.col("doc_id")).collect()
    keys = sum(len(re.findall(r'token = "[0-9a-f]{40}"', r.text or "", re.I)) for r in rows)
    found = [r.text[int(s) : int(e)] for r in rows for k, s, e in (x.split(":") for x in r.spans.split(",") if x) if k == pii.FOUND]
    assert keys and sum(bool(re.fullmatch("[0-9a-fA-F]{40}", v)) for v in found) == keys
    assert all(re.fullmatch("[0-9a-fA-F]{40}", v) for v in found)


def test_overlaps_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "mail 4111111111111111@x.org or +4111111111111111 end", None)], "doc_id long, text string, `a``b` string")
    none = pii.learn(docs.limit(0))
    assert none.count() == 0
    assert pii.redact(docs, none).first().text == "mail <email> or +<card> end" and pii.redact(docs, none).columns == docs.columns
    empty = docs.limit(0)
    assert pii.find(empty, none).count() == 0 and pii.redact(empty, none).count() == 0


def test_registered_query(spark, tmp_path):
    rows = [(1, "to a.b@c.de and 4111 1111 1111 1111", "en"), (2, None, "en"), (2, "+1 (415) 555-2671 1.2.3.4", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(queries.op5_pii(spark, str(tmp_path)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "spans").collect(), key=lambda r: (r[0], r[5]))
    assert [tuple(r) for r in got] == [(1, 1, 0, 1, 0, "email:3:11,card:16:35"), (2, 0, 0, 0, 0, ""), (2, 0, 1, 0, 1, "ip:18:25,phone:0:25")]

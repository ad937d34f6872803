import random
import re

import corpus_pipeline as pipeline
from strandframe.llm import pii
from strandframe.llm.common import written


def make(spark):
    rng = random.Random(9)
    parts = {"xx": ["ka", "to", "mi", "re", "su"], "yy": ["sch", "und", "eit", "ge", "lich"]}
    vocab = {k: ["".join(rng.choices(p, k=rng.randint(1, 4))) for _ in range(300)] for k, p in parts.items()}
    rows = []
    for i in range(120):
        lang = rng.choice(["xx", "yy"])
        rows.append((i, " ".join(rng.choices(vocab[lang], k=rng.randint(60, 200))), lang, f"s{i % 3}"))
    for i in range(20):
        words = rows[i][1].split()
        words[30] = "edited"
        rows.append((200 + i, " ".join(words), rows[i][2], "s0"))
    rows += [(300 + i, rows[50][1], rows[50][2], "s1") for i in range(10)]
    rows += [(400, None, "xx", "s1"), (401, "", None, None), (402, "12 34", "yy", "s2"), (403, rows[60][1] + " mail me a.b@c.example now", rows[60][2], "s2")]
    rows[70] = (70, rows[70][1] + " +1 (415) 555-2671 x", rows[70][2], "s2")
    return rows, spark.createDataFrame([(*r, len(r[1] or ""), 5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score int")


def test_stages(spark):
    rows, docs = make(spark)
    text = dict((r[0], r[1]) for r in rows)
    seen = docs
    for name, stage in pipeline.STAGES[:-1]:
        out = written(stage(spark, seen, ""), name)
        assert out.columns == docs.columns
        before, after = ({r.doc_id: r for r in x.collect()} for x in (seen, out))
        if name == "language_id":
            assert {400, 401, 402}.isdisjoint(after) and len(after) >= len(before) - 4
        elif name == "simhash_near_dedup":
            assert set(after).isdisjoint(range(300, 310)) and 50 in after
            assert sum(200 + i in after for i in range(20)) <= 1 and all(i in after for i in range(20) if i in before)
            assert len(after) >= 117
        elif name == "pii":
            assert set(after) == set(before) and "<phone>" in after[70].text
            assert all(not pii.base_spans(r.text) and r.n_chars == len(r.text) for r in after.values())
            assert all(r.text == text[i] for i, r in after.items() if not re.search(r"[0-9@]", text[i]))
        else:
            assert sorted(map(str, after.values())) == sorted(map(str, before.values()))
        seen = out
    last = pipeline.STAGES[-1][1](spark, seen, "").collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in seen.collect()}
    per: dict = {}
    for r in last:
        per.setdefault(r.doc_id, []).append(r)
    assert all(sum(x.length for x in p) == p[0].doc_tokens for p in per.values())

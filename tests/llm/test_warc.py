import base64
import gzip
import hashlib
import random

from strandframe.llm import warc
from strandframe.llm.common import scratch


def brute(rows, least):
    best = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            best[h or ""] = max(i, best.get(h or "", i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        ref = best.get(h or "")
        ref = None if ref == i or len(p) < least else ref
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark):
    rng = random.Random(8)
    bodies = ["", None, "a", "\r\n\r\n", "WARC/1.1\r\n\r\nx", "é" * 3000, "long " * 40000, *(f"<p>{i}</p>" for i in range(20))]
    rows = [(i * 3 - 50, rng.choice([None, "", "http://www.A.example/x y", f"https://b.example:8080/{i % 5}?q={i}", "not a url", "http://[bad"]), rng.choice(bodies)) for i in range(200)]
    rows += [(7, "http://same.example/", "same id, one"), (7, "http://same.example/", "same id, two"), (None, None, "no id"), (None, "u", "no id")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string").repartition(4)
    for least in (0, 5):
        assert sorted(map(tuple, warc.round_trip(pages, least_bytes=least).collect()), key=str) == brute(rows, least)


def test_index_finds_keys_and_only_those(spark):
    rows = [(f"com,host{i % 7})/{i:04d} {i:020d}", "f", i, 1) for i in range(1000)]
    index = warc.build_index(spark.createDataFrame(rows, "ckey string, file string, offset long, length long").repartition(3), block_lines=37)
    firsts, lasts, _ = warc.directory(index)
    assert firsts == sorted(firsts) and len(firsts) >= 1000 // 37 and all(a <= b for a, b in zip(firsts, lasts))
    wanted = [rows[5][0], rows[999][0], "absent", "com,host3)/0500", "zzz"]
    got = warc.lookup(index, spark.createDataFrame([(k,) for k in wanted], "ckey string")).collect()
    assert sorted(r.offset for r in got) == [5, 999]


def test_records_and_files(spark):
    data = warc.record(5, "http://a.example/b c", b"body\r\n\r\n", "D", None)
    assert b"WARC-Target-URI: http://a.example/b%20c\r\n" in data and warc.read_record(data)["payload"] == b"body\r\n\r\n"
    back = warc.read_record(warc.record(5, None, b"body", "D", 9))
    assert (back["type"], back["refers_to"], back["payload"]) == ("revisit", 9, None)
    pages = spark.createDataFrame([(i, f"http://a.example/{i}", "x" * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    folder = scratch(spark, "warc")
    captures = warc.write_archives(warc.classified(pages, 0, "page_id", "url", "html"), folder, file_bytes=2000).collect()
    assert len({c.file for c in captures}) > 2
    for c in captures:
        with open(f"{folder.removeprefix('file://')}/{c.file}", "rb") as f:
            f.seek(c.offset)
            assert warc.read_record(gzip.decompress(f.read(c.length)))["digest"]
    assert warc.url_key("HTTPS://user@www.Blog.example.com:443/a/B?q=1#frag") == "com,example,blog)/a/B?q=1"


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

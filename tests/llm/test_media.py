import hashlib
import zlib

import pytest

from strandframe.llm import media


def test_png_round_trip():
    for n in (1, 3, 500):
        data = bytes((i * 7 + n) % 256 for i in range(64 * n))
        assert media.decode_png(media.encode_png(data)) == data
    broken = bytearray(media.encode_png(bytes(64)))
    broken[40] ^= 1
    with pytest.raises(ValueError):
        media.decode_png(bytes(broken))


def test_parse_keeps_order_and_captions():
    page = '<p>one <b>bold</b> &amp; x</p><figure><img src="a.png" alt="alt"><video src="v"></video><figcaption>cap <i>t</i></figcaption></figure>two<img src=b alt="B"><img alt="none"><script>var a="<p>";</script><ul><li>three<li>four</ul>'
    got = [(x["position"], x["kind"], x["text"] or x["ref"], x["caption"]) for x in media.parse(page)]
    assert got == [(0, "text", "one bold & x", None), (1, "media", "a.png", "cap t"), (2, "media", "v", "cap t"), (3, "text", "two", None), (4, "media", "b", "B"), (5, "text", "three", None), (6, "text", "four", None)]
    assert media.parse(None) == [] and media.parse("") == [] and media.parse("<p><p></div>") == []


def test_sequences(spark):
    pages = spark.createDataFrame([(1, "<p>a</p><img src=x>", 1), (2, None, 1), (1, "text", 1)], "page_id long, html string, items int")
    got = sorted((r.id, len(r.items)) for r in media.sequences(pages).collect())
    assert got == [(1, 1), (1, 2), (2, 0)]


def test_round_trip(spark):
    texts = [None, "", "a", "x" * 64, "x" * 65, "é\n<b> & 'q'\n\n" * 30, "long\n" * 40_000, *["copy"] * 40]
    docs = spark.createDataFrame([(i if i != 3 else None, t, 1, "f") for i, t in enumerate(texts)], "doc_id long, text string, position int, feature string").repartition(3)
    got = media.round_trip(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        raw = (texts[r.id if r.id is not None else 3] or "").encode()
        payload = raw + bytes(max(1, -(-len(raw) // 64)) * 64 - len(raw))
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.media_sha256 == hashlib.sha256(media.encode_png(payload)).hexdigest() == r.ref.removeprefix("sha256:")
        assert r.media_bytes == len(media.encode_png(payload)) and r.feature == media.feature(payload) and r.caption == f"text of {len(raw)} bytes"
    assert media.round_trip(docs.limit(0)).count() == 0


def test_unknown_reference(spark):
    refs = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "ref string, k int")
    known = spark.createDataFrame([("a", 9)], "ref string, v int")
    assert sorted(map(str, map(tuple, media.resolve(refs, known).collect()))) == ["('a', 1, 9)", "('b', 2, None)", "(None, 3, None)"]

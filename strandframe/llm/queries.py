"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, media, merkle, mixing, packing, phrases, pii, sharding, simhash, spelling, tokens, toxicity, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    field = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=~_held_out())
    return toxicity.tag(docs, field).withColumnRenamed("id", "doc_id").withColumn("held_out", _held_out())


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_documents(spark, sf_dir), 24).withColumnRenamed("id", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return pii.find(docs, pii.learn(docs)).withColumnRenamed("id", "doc_id")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.train(docs, keep=~_held_out())
    return langid.identify(docs.select("doc_id", "text", _held_out().alias("held_out")), model).drop("text")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id").withColumnRenamed("items", "n_items")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir).select("doc_id", "text", "source")).drop("text")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_documents(spark, sf_dir), words=4, radius=4, segments=3)
    digits = F.concat(*[F.substring(F.lower(F.hex("fp")), i, 2) for i in range(15, 0, -2)])  # the most significant byte first
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir))


_OP12 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
u AS (SELECT lang, unnest(w) AS x FROM w),
g AS (SELECT lang, [x] AS g FROM u UNION ALL SELECT lang, unnest([[w[i], w[i + 1]] FOR i IN range(1, len(w))]) FROM w UNION ALL SELECT lang, unnest([[w[i], w[i + 1], w[i + 2]] FOR i IN range(1, len(w) - 1)]) FROM w),
f AS (SELECT lang, array_to_string(g, ' ') AS x, len(g) AS k, g, count(*) AS n FROM g GROUP BY lang, g HAVING count(*) >= 10),
cut AS (SELECT c.lang, c.x, c.g, c.k, c.n AS a, i, array_to_string(c.g[1:i], ' ') AS one, array_to_string(c.g[i + 1:], ' ') AS two FROM f c, range(1, 3) AS cuts(i) WHERE c.k > i),
s AS (SELECT cut.*, l.n AS l, r.n AS r, (1000000::HUGEINT * a * a) // (l.n::HUGEINT * r.n) AS score FROM cut JOIN f l ON l.lang = cut.lang AND l.x = one JOIN f r ON r.lang = cut.lang AND r.x = two),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, i) = 1),
inside AS (SELECT lang, x, max(n) AS n FROM (SELECT lang, array_to_string(g[1:2], ' ') AS x, n FROM f WHERE k = 3 UNION ALL SELECT lang, array_to_string(g[2:3], ' '), n FROM f WHERE k = 3) GROUP BY lang, x),
c AS (SELECT b.* FROM b LEFT JOIN inside USING (lang, x) WHERE inside.n IS NULL OR 100 * inside.n < 50 * a),
total AS (SELECT lang, count(*) AS n FROM u GROUP BY lang)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, x) AS rank, x AS phrase, a, l, r, total.n AS n, CAST(score AS BIGINT) AS score
FROM c JOIN total ON total.lang = c.lang QUALIFY rank <= 2000"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(_documents(spark, sf_dir))


# The CRC-32 table is worked out from its polynomial, 0xEDB88320.
_OP13 = r"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS crc FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
run AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
d AS (SELECT run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM run GROUP BY id, run),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || x[2 * i - 1:2 * i])::BIGINT FOR i IN range(1, len(x) // 2 + 1)]), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM d, crc),
e AS (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
del AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pair AS MATERIALIZED (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM del a JOIN del b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT del.word, del.n, v.word, v.n FROM del JOIN v ON del.rest = v.word UNION SELECT v.word, v.n, del.word, del.n FROM del JOIN v ON del.rest = v.word),
best AS (SELECT word, count(*) AS n_near, (min({'k': -near_n, 'near': near, 'n': near_n})) AS b FROM pair GROUP BY word),
form AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 2 * v.n THEN b.near END AS form, CASE WHEN b.n >= 2 * v.n THEN b.n END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM form UNION ALL SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.at WHERE form.form IS NOT NULL)
SELECT form.word, form.form, walk.at AS root, form.n, form.n_near, form.form_n FROM form JOIN walk ON walk.word = form.word JOIN form top ON top.word = walk.at AND top.form IS NULL"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op12_phrases": _OP12, "op13_spelling": _OP13}

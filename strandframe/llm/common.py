"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Text bytes that a Python worker holds as words or shingles at a time (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Without the setting a temporary folder serves sessions that run on this machine
    alone; on a cluster, whose executors would not see it, that is an error.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut and lost executors cost nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns named ``c0, c1, ...``."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def sums_before(df: DataFrame, keys: list[str], order: str, value: str, name: str, width: int = 1024) -> DataFrame:
    """``df`` (one row for ``keys`` and ``order``, a long from 0) and ``name``: the sum of ``value`` over the rows of the same keys before it.

    Sums run in two levels, within stretches of ``width`` and over the stretches, so that
    a task holds a stretch or one row for each stretch of a key.
    """
    rows = df.withColumn("__stretch", F.expr(f"`{order}` div {width}"))
    whole = rows.groupBy(*keys, "__stretch").agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(*keys) if keys else Window
    base = whole.withColumn("__base", F.sum("__sum").over(over.orderBy("__stretch")) - F.col("__sum")).drop("__sum")
    inner = F.sum(value).over(Window.partitionBy(*keys, "__stretch").orderBy(order)) - F.col(value)
    return rows.withColumn("__inner", inner).join(base, [*keys, "__stretch"]).withColumn(name, F.col("__base") + F.col("__inner")).drop("__stretch", "__inner", "__base")


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of ``column`` each, and one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if len(sizes) > start:
            yield batch.slice(start)


def join_hot(left: DataFrame, right: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """Left join of ``left`` (any number of rows for a key) with ``right`` (one row for a key).

    Keys with over 1/``most`` of the rows of ``left`` number fewer than ``most``, so
    their part of ``right`` is broadcast and their rows are not shuffled. The other
    keys take an ordinary join, and rows without a key take none. ``left`` is read
    twice or more: give a written table.
    """
    total = left.count()
    counts = left.where(F.col(key).isNotNull()).groupBy(key).count()
    hot = counts.where(F.col("count") * most > F.lit(total)).select(F.col(key).alias("__hot"))
    values = [c for c in right.columns if c != key]
    known = right.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left_semi").select(F.col(key).alias("__hot"), *[F.col(c).alias(f"__r_{c}") for c in values])
    part = hot.join(F.broadcast(known), "__hot", "left")
    marked = left.join(F.broadcast(part), F.col(key) == F.col("__hot"), "left")
    done = marked.where(F.col("__hot").isNotNull() | F.col(key).isNull()).select(*left.columns, *[F.col(f"__r_{c}").alias(c) for c in values])
    rest = left.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left_anti").where(F.col(key).isNotNull())
    return done.unionByName(rest.join(right, key, "left").select(*left.columns, *values))


def _with_least(edges: DataFrame, least: DataFrame, total: int, most: int = 1000) -> DataFrame:
    """``edges (a, b)`` with ``least (a, m, n)`` of their a; nodes with over 1/``most`` of the edges (fewer than ``most``) are broadcast."""
    hot = least.where(F.col("n") * most > F.lit(total)).select("a", "m")
    dealt = edges.join(F.broadcast(hot), "a")
    return dealt.unionByName(edges.join(F.broadcast(hot), "a", "left_anti").join(least.select("a", "m"), "a"))


def large_star_small_star(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)``: ``(a, b)`` where b is the least node of a's component.

    Alternates large-star and small-star until the edges stay the same; only least
    neighbours are aggregated, never lists of them, and edges of hubs stay where they
    are. Nodes that are least in their component, and nodes without an edge, have no
    row. Null nodes are left out.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count("*").alias("n")), "least")
        large = written(_with_least(both, least, 2 * mark[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        small = _with_least(large, least, mark[0])
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = written(small.where("a <> b").distinct(), "edges")

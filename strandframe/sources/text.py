"""Text formats as tables, and tables as text. Parquet is the format between stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.alleles import parse_info, upto

#: Bases in a chunk of a reference sequence.
CHUNK = 1 << 14

#: Number of reserved fields of the format's specification, for tables without a header.
INFO_NUMBERS = {"AC": "A", "AF": "A", "AD": "R", "ADF": "R", "ADR": "R", "MLEAC": "A", "MLEAF": "A"}
FORMAT_NUMBERS = {"AD": "R", "ADF": "R", "ADR": "R", "PL": "G", "GL": "G", "GP": "G", "PP": "G", "EC": "A"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(variants, header)``: records with 0-based ``pos``, and the lines that begin with ``#``.

    ``file_order`` rises with the place in the file. ``samples`` holds a map for each
    sample column; ``GT`` is that of the first.
    """
    lines = _lines(spark, path)
    header = lines.where(F.col("value").startswith("#"))
    cols = F.split("value", "\t")
    col = lambda k: F.get(cols, F.lit(k))
    keys = F.when(col(8).isNull() | (col(8) == "."), F.array().cast("array<string>")).otherwise(F.split(col(8), ":"))
    samples = F.transform(F.slice(cols, 10, F.greatest(F.size(cols) - 9, F.lit(0))), lambda s: F.map_from_entries(F.filter(F.arrays_zip(F.col("format").alias("k"), F.split(s, ":").alias("v")), lambda e: e["k"].isNotNull() & e["v"].isNotNull())))
    rows = lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).withColumn("file_order", F.monotonically_increasing_id())
    rows = rows.select("file_order", "value", keys.alias("format"))
    v = rows.select(
        col(0).alias("ctg"),
        (col(1).cast("long") - 1).alias("pos"),
        (col(1).cast("long") - 1 + F.length(col(3))).alias("end"),
        col(2).alias("id"),
        col(3).alias("ref"),
        F.when(col(4) == ".", F.array().cast("array<string>")).otherwise(F.split(col(4), ",")).alias("alt"),
        F.when(col(5) != ".", col(5).cast("double")).alias("qual"),
        F.when(col(6) == ".", F.array().cast("array<string>")).otherwise(F.split(col(6), ";")).alias("filter"),
        parse_info(col(7)).alias("info"),
        "format",
        samples.alias("samples"),
        "file_order",
    )
    return v.withColumn("GT", F.get("samples", F.lit(0))["GT"]), header


def info_array(name: str, kind: str = "int") -> Column:
    """A field of INFO as an array."""
    return F.split(F.col("info")[name], ",").cast(f"array<{kind}>")


def sample_array(name: str, kind: str = "int", k: int = 0) -> Column:
    """A field of a sample as an array; null where it is missing."""
    value = F.get("samples", F.lit(k))[name]
    return F.when(value != ".", F.split(value, ",").cast(f"array<{kind}>"))


def header_contigs(header: DataFrame) -> DataFrame:
    """``(ctg, length)`` of the contig lines; the length may be null."""
    line = header.where(F.col("value").startswith("##contig=")).select("value")
    get = lambda key: F.regexp_extract("value", rf"[<,]{key}=([^,>]*)", 1)
    return line.select(get("ID").alias("ctg"), F.when(get("length") != "", get("length")).cast("long").alias("length"))


def header_value(header: DataFrame, key: str) -> DataFrame:
    return header.where(F.col("value").startswith(f"##{key}=")).select(F.substring("value", len(key) + 4, 1 << 30).alias("value"))


def header_fields(header: DataFrame, number: str = "A", kind: str = "INFO") -> DataFrame:
    """Ids of the header lines of a kind with this Number."""
    own = header.where(F.col("value").startswith(f"##{kind}=") & F.col("value").contains(f",Number={number},"))
    return own.select(F.regexp_extract("value", r"<ID=([^,>]+)", 1).alias("id"))


def header_lines(header: DataFrame) -> DataFrame:
    """``(kind, id, number, type, line)`` of the structured header lines."""
    get = lambda key: F.regexp_extract("value", rf"[<,]{key}=([^,>]*)", 1)
    return header.where(F.col("value").rlike("^##[A-Za-z]+=<")).select(F.regexp_extract("value", "^##([A-Za-z]+)=", 1).alias("kind"), get("ID").alias("id"), get("Number").alias("number"), get("Type").alias("type"), F.col("value").alias("line"))


def field_numbers(header: DataFrame, kind: str = "INFO", most: int = 10_000) -> dict[str, str]:
    """Number of each field that the header declares, as a dictionary: a header does not grow with the records (over ``most`` fields are an error)."""
    rows = header_lines(header).where(F.col("kind") == kind).select("id", "number").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a header of over {most} fields of {kind}")
    return {r["id"]: r["number"] for r in rows}


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """``(ctg, start, end)``; comments, track lines and lines of fewer than three fields are skipped."""
    cols = F.split("value", "\t")
    rows = _lines(spark, path).where(~F.col("value").startswith("#") & ~F.col("value").startswith("track") & (F.size(cols) >= 3))
    return rows.select(F.get(cols, F.lit(0)).alias("ctg"), F.get(cols, F.lit(1)).cast("long").alias("start"), F.get(cols, F.lit(2)).cast("long").alias("end"))


def read_bed4(spark: SparkSession, path: str) -> DataFrame:
    """``(ctg, start, end, n)``; a line of fewer than four fields is an error."""
    cols = F.split("value", "\t")
    rows = _lines(spark, path).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    n = F.when(F.size(cols) >= 4, F.get(cols, F.lit(3))).otherwise(F.raise_error(F.lit("a region of fewer than four fields"))).cast("int")
    return rows.select(F.get(cols, F.lit(0)).alias("ctg"), F.get(cols, F.lit(1)).cast("long").alias("start"), F.get(cols, F.lit(2)).cast("long").alias("end"), n.alias("n"))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """A FASTA index; a line of another shape is an error. ``ctg_idx`` is the order of the file."""
    schema = "ctg string, length long, offset long, linebases int, linewidth int"
    return spark.read.csv(path, sep="\t", schema=schema, mode="FAILFAST").withColumn("ctg_idx", F.monotonically_increasing_id())


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """``(ctg, chunk, seq)``: pieces of ``chunk`` bases, the last one shorter; a record without bases gives none.

    A line finds its place by the bases before it: running sums within each block of a
    file, and over the blocks' totals. Files follow one another by name, blocks by their
    place in the file: partitions hold blocks in any order. No task holds more than a
    block or a chunk.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    head = F.col("value").startswith(">")
    bases = F.regexp_replace("value", r"\s", "")
    block = ("__file", "__block")
    own = Window.partitionBy(*block).orderBy("__id")
    rows = lines.select(*block, "__id", F.when(head, F.regexp_extract("value", r"^>\s*(\S*)", 1)).alias("name"), F.when(~head, bases).otherwise("").alias("seq"))
    rows = rows.withColumns({"__seg": F.count("name").over(own), "ctg": F.last("name", ignorenulls=True).over(own)})
    rows = rows.withColumn("__off", F.sum(F.length("seq")).over(Window.partitionBy(*block, "__seg").orderBy("__id")) - F.length("seq"))
    # one row for each block: what its last record, or all of it, hands on to the next
    tail = F.struct("__seg", "__off", F.length("seq").alias("n"), "ctg", "__id")
    blocks = rows.groupBy(*block).agg(F.max_by(tail, "__id").alias("t")).select(*block, F.col("t.ctg").alias("__name"), (F.col("t.__off") + F.col("t.n")).alias("__total"))
    order = Window.orderBy(*block)
    blocks = blocks.withColumns({"__record": F.count("__name").over(order), "__after": F.last("__name", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))})
    until = Window.partitionBy("__record").orderBy(*block)
    # of the blocks of a record the first has its name, and the last one's successor takes the sum of all
    blocks = blocks.withColumn("__sum", F.sum("__total").over(until))
    blocks = blocks.select(*block, "__after", F.coalesce(F.lag("__sum").over(order), F.lit(0)).alias("__base"))
    carried = F.when(F.col("__seg") == 0, F.col("__base")).otherwise(0)
    placed = rows.where("seq <> ''").join(F.broadcast(blocks), list(block)).select(F.coalesce("ctg", "__after").alias("ctg"), "seq", (carried + F.col("__off")).alias("__at"))
    last = F.floor((F.col("__at") + F.length("seq") - 1) / chunk).cast("long")
    cut = placed.where("ctg is not null").select("ctg", "seq", "__at", F.explode(F.sequence(F.floor(F.col("__at") / chunk).cast("long"), last)).alias("chunk"))
    first = F.greatest(F.col("chunk") * chunk - F.col("__at"), F.lit(0))
    piece = F.substring(F.col("seq"), (first + 1).cast("int"), (F.least((F.col("chunk") + 1) * chunk - F.col("__at"), F.length("seq")) - first).cast("int"))
    parts = cut.select("ctg", "chunk", F.struct((F.col("__at") + first).alias("at"), piece.alias("s")).alias("p"))
    return parts.groupBy("ctg", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["s"]), "").alias("seq"))


def ref_slice(rows: DataFrame, chunks: DataFrame, key: str, chunk: int = CHUNK, name: str = "bases") -> DataFrame:
    """``rows`` (unique ``key``; ``ctg, start, end``) and the reference bases of ``[start, end)``.

    A negative start counts as 0; empty ranges and contigs without a sequence give ``''``.
    """
    s = F.greatest("start", F.lit(0))
    wanted = rows.where(F.col("end") > s).select(key, "ctg", s.alias("__s"), F.col("end").alias("__e"), F.explode(F.sequence(F.floor(s / chunk).cast("long"), F.floor((F.col("end") - 1) / chunk).cast("long"))).alias("chunk"))
    first = F.greatest(F.col("__s") - F.col("chunk") * chunk, F.lit(0))
    part = F.substring(F.col("seq"), (first + 1).cast("int"), (F.least(F.col("__e") - F.col("chunk") * chunk, F.lit(chunk)) - first).cast("int"))
    found = wanted.join(chunks, ["ctg", "chunk"]).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", part.alias("p")))), lambda x: x["p"]), "").alias(name))
    return rows.join(found, key, "left").withColumn(name, F.coalesce(name, F.lit("")))


def read_repeat_model(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, sep="\t", schema="unit string, n int, c3 int, c4 int, costs string", mode="FAILFAST")
    return rows.withColumn("cost", F.transform_values(F.transform_keys(F.str_to_map("costs", F.lit(","), F.lit(":")), lambda k, _: k.cast("int")), lambda _, v: v.cast("double"))).drop("costs")


def read_idxstats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="ctg string, length long, mapped long, unmapped long").where("ctg <> '*'")


def read_ploidy_json(spark: SparkSession, path: str) -> DataFrame:
    schema = "contigs map<string,struct<normalized_coverage:string,ploidy:string>>, sex string"
    return spark.read.schema(schema).json(path, multiLine=True)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """``(read_id, seq, qual)``: four lines make a read. A task reads a whole file in order, gzipped or not.

    Plain files would be split between lines of a read, so they are read as one record
    each, which has to fit into a task; gzip large ones, or give them as Parquet.
    """
    names = spark.read.format("binaryFile").load(path).select("path")
    plain = [r["path"] for r in names.where(~F.col("path").endswith(".gz")).collect()]
    packed = [r["path"] for r in names.where(F.col("path").endswith(".gz")).collect()]
    parts = []
    if packed:
        lines = spark.read.text(packed).withColumns({"__part": F.spark_partition_id().cast("string"), "__n": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
        parts.append(lines.select("value", "__part", "__n"))
    if plain:
        whole = spark.read.text(plain, wholetext=True).select(F.input_file_name().alias("__part"), F.posexplode(F.split("value", "\r?\n")).alias("__n", "value"))
        parts.append(whole.select("value", "__part", F.col("__n").cast("long").alias("__n")))
    if not parts:
        return spark.createDataFrame([], "read_id string, seq string, qual string")
    lines = reduce(DataFrame.unionByName, parts)
    kind = F.col("__n") % 4
    of = lambda k: F.max(F.when(kind == k, F.col("value")))
    reads = lines.groupBy("__part", F.floor(F.col("__n") / 4).alias("__read")).agg(of(0).alias("head"), of(1).alias("seq"), of(3).alias("qual"))
    return reads.where("head <> ''").select(F.regexp_extract("head", r"^@(\S+)", 1).alias("read_id"), "seq", "qual")


def genome_order(rows: DataFrame, contigs: DataFrame, *columns: str) -> DataFrame:
    """``rows`` sorted by the contigs' order ``(ctg, ctg_idx)``, then by ``columns``; contigs not listed come last."""
    return rows.join(F.broadcast(contigs.select("ctg", "ctg_idx")), "ctg", "left").orderBy(F.col("ctg_idx").asc_nulls_last(), *columns).select(*rows.columns)


def vcf_lines(v: DataFrame) -> Column:
    """A variant row as a line of text."""
    texts = lambda c: F.when(F.size(c) > 0, F.array_join(c, "," if c == "alt" else ";")).otherwise(".")
    info = F.array_join(F.transform(F.map_entries("info"), lambda e: F.when(e["value"].isNull(), e["key"]).otherwise(F.concat(e["key"], F.lit("="), e["value"]))), ";")
    sample = lambda s: F.array_join(F.transform("format", lambda k: F.coalesce(s[k], F.lit("."))), ":")
    tail = F.when(F.size("format") > 0, F.concat(F.lit("\t"), F.array_join("format", ":"), F.lit("\t"), F.array_join(F.transform("samples", sample), "\t"))).otherwise("")
    qual = F.coalesce(F.regexp_replace(F.col("qual").cast("string"), r"\.0$", ""), F.lit("."))
    return F.concat(F.concat_ws("\t", "ctg", F.col("pos") + 1, F.coalesce("id", F.lit(".")), "ref", texts("alt"), qual, texts("filter"), F.when(F.size("info") > 0, info).otherwise(".")), tail)


def write_vcf(v: DataFrame, header: DataFrame, contigs: DataFrame, path: str) -> None:
    """A folder of part files: the header's lines, in order, and then the records in genome order.

    Dealing rows to ranges reads them twice, so lines and places are first stored beside
    (``_placed``, which Spark's readers pass over), and ``v`` is worked out once.
    """
    spark = v.sparkSession
    header.select("value").coalesce(1).write.text(f"{path}/header")
    placed = v.withColumn("value", vcf_lines(v)).join(F.broadcast(contigs.select("ctg", "ctg_idx")), "ctg", "left").select("ctg_idx", "pos", "end", "value")
    placed.write.parquet(f"{path}/_placed")
    stored = spark.read.schema(placed.schema).parquet(f"{path}/_placed")
    ordered = stored.repartitionByRange("ctg_idx", "pos", "end").sortWithinPartitions("ctg_idx", "pos", "end")
    ordered.select("value").write.text(f"{path}/records")


def write_bed(iv: DataFrame, path: str) -> None:
    iv.write.csv(path, sep="\t")


def ploidy_json(ploidies: DataFrame, sex: DataFrame) -> DataFrame:
    """One row ``value``: the result as nested JSON with numbers as text."""
    entry = F.struct("ctg", F.struct(F.col("normalized_coverage").cast("string").alias("normalized_coverage"), "ploidy").alias("v"))
    return ploidies.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("contigs")).crossJoin(sex).select(F.to_json(F.struct("contigs", "sex")).alias("value"))


def write_ploidy_json(ploidies: DataFrame, sex: DataFrame, path: str) -> None:
    ploidy_json(ploidies, sex).coalesce(1).write.text(path)


def write_variants_parquet(v: DataFrame, path: str) -> None:
    """Partitioned by contig, so later reads prune."""
    v.write.partitionBy("ctg").parquet(path)

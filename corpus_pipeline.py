"""A training corpus from documents: identify the language, drop near duplicates, redact personal data, mix sources, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.llm import langid, mixing, packing, pii, simhash
from strandframe.llm.common import written

#: Documents that a task hands to its Python worker at a time. Spark's 10,000 whole texts are held by executor and worker at once.
BATCH_ROWS = 2000


def _small_batches(spark: SparkSession) -> None:
    """From now on the session's tasks hand over BATCH_ROWS rows at a time, or as many as it says if they are fewer."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; texts without a letter and texts unlike any language go."""
    _small_batches(spark)
    found = langid.identify(docs, langid.train(docs), prefix="__")
    return found.where("not __rejected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    _small_batches(spark)
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    _small_batches(spark)
    return pii.redact(docs, pii.learn(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix."""
    return mixing.in_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of 2048 tokens, which follow the mix: its order is found again from the documents."""
    import public_tokenizers

    _small_batches(spark)
    place = F.struct("slot", "block_offset")
    mixed = mixing.mix(docs.select("doc_id", "text", "source"))
    return packing.pack_documents(mixed, public_tokenizers.path("byte_bpe_50k.json"), place=place).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("source_mixing", source_mix),
    ("packing", pack),
]

#: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

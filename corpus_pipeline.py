"""A training-data pipeline over ``documents``: language, near duplicates, benchmark leaks, mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet and reads it
again as the next stage's documents. All stages but the last return the columns of ``documents``.

Nulls, empty and repeated rows: a document without a letter (null and empty text included) goes in the first stage, as do
all where no row has a known language; of rows that repeat doc_id and text the second keeps one, and rows without doc_id
or with a doc_id of several texts are documents like others there; a null source is a source of its own; an empty table
passes through all stages; columns other than those of documents are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, langid, mixing, sharding
from tidemark.sources.tables import discard, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told, with it where ``lang`` is null; fitted on the documents with a known one."""
    profiles = langid.fit_profiles(docs.select("doc_id", "text", "lang"))
    found = langid.predict_language(docs.select(*COLUMNS), profiles, keep=tuple(COLUMNS))
    told = found.where(F.col("lang_pred") != langid.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the row of the least doc_id."""
    return jaccard.drop_near_duplicates(docs.select(*COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the document at a source's budget is taken whole."""
    own = docs.select(*COLUMNS, F.md5("text").alias("__text"))
    plan = mixing.plan_mix(own, keep=["__text"]).where("taken > 0")
    # Repeated rows have one plan between them.
    copies = plan.groupBy(F.col("doc_id").alias("__id"), F.col("__text").alias("__t")).agg(F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias("__copies"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__text").eqNullSafe(F.col("__t"))
    repeated = own.join(copies, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, source, lang."""
    return sharding.shard_documents(docs, 40, keep=["source", "lang"])


STAGES = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        kept = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if k:
            discard(docs)
        docs = kept
    return docs

"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before kept, written as Parquet and read again, and returns documents
with the same columns; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.llm import decontaminate, jaccard, packing, pii, quality
from logweft.llm.landing import landed, small
from logweft.llm.queries import VOCABULARY

#: Documents below this score go.
KEEP_FROM = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(docs, quality.train_quality(docs, labels, F.lit(True)), score="_score")
    return scored.where(F.col("_score") >= KEEP_FROM).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that with the smallest id, and of the rows of
    an id that which is least by all its columns.  Documents without words, and rows without an id, stay."""
    config = jaccard.JaccardConfig(words=5, percent=80)
    found = jaccard.near_duplicates(docs, config)
    ids = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    # Texts are shuffled for many ids only.
    named = landed(ids.where("component_id < doc_id or n > 1"), "duplicates")
    several = small(named.where("component_id = doc_id").select("doc_id"), config.broadcast_rows)
    gone = small(named.select("doc_id"), config.broadcast_rows)
    one_each = docs.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns).unionByName(one_each.select("row.*"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark text."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind, and their length brought up to date."""
    found = pii.mask_pii(docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, one row each."""
    return packing.pack_documents(docs, packing.PackConfig(VOCABULARY))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("PII", mask_personal_data),
    ("packing", pack),
]

#: SQL can express neither a trained classifier nor a tokenizer; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = landed(docs, f"corpus-{number}")
    return docs

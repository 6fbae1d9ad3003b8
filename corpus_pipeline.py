"""From raw documents to packed sequences, in stages that are written and read again in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table, with_package
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.ngram_join import similar_documents
from millrace.llm.packing import pack
from millrace.llm.queries import tokenizer_file
from millrace.llm.substring_dedup import without_repeats
from millrace.llm.toxicity import fit, probability, scan
from millrace.session import scratch_path


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with an id (``keep_id``) in ``ids``; null is an id like others."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("row_id"))
    kept = rows.join(ids.distinct(), F.col("row_id").eqNullSafe(F.col("keep_id")), "left_semi")
    return kept.select(*(F.col("row")[n].alias(n) for n in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not more likely toxic than not."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), scan(model, F.col("text"))["evidence"].alias("evidence"))
    clean = rows.where(probability(model, F.col("evidence")) < 0.5)
    return clean.select(*(F.col("row")[n].alias(n) for n in docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id; rows that repeat id and text are one."""
    kept = exact_duplicates(docs).where("kept").select("keep_id")
    return _only(docs, kept).dropDuplicates(["doc_id", "text"])


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents, the one of smallest id."""
    found = similar_documents(docs)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return _only(docs, first.select(F.col("doc_id").alias("keep_id")))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each passage only in the one of smallest id that holds it."""
    rest = without_repeats(docs)
    if "n_chars" in rest.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast(rest.schema["n_chars"].dataType))
    return rest


def pack_all(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_similar),
    ("substring_dedup", cut_repeats),
    ("packing", pack_all),
]
# Learned scores, MinHash bands and packing are beyond SQL; the tests go by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written to the shared folder."""
    docs = table(with_package(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

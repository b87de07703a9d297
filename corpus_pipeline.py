"""A corpus from raw documents to packed batches: each stage is written as Parquet and read again for the next.

Toxic documents go, one document of each group of near copies stays, documents that hold benchmark items
go, secrets are masked, and what is left is packed into batches. Clean documents pass all stages unchanged.

Every stage is lazy over its docs, which may be the result of another stage that is not written yet. Rows with
null or empty columns, equal rows and columns of any names are defined by each stage's operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmill.llm import decontamination, jaccard_join, packing, scratch, secret_scan, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic, as they are; it learns from the labels and from docs. See toxicity.reject_toxic."""
    return toxicity.reject_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, as it is, and those without doc_id or words. See jaccard_join.keep_one."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, as they are. See decontamination.drop_contaminated."""
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with [SECRET] for each secret in text and n_chars to match; models are trained on docs. See secret_scan.redact."""
    return secret_scan.redact(docs, secret_scan.fit(secret_scan.corpus_samples(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in length buckets and batches, and their text. See packing.pack."""
    return packing.pack(docs, carry=("text",))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("packing", pack),
]

#: The classifier has no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed batches of documents with their masked texts: all stages, each one's result written and read again.

    The tables that a stage writes on its way are deleted with it.
    """
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch.tables(spark):
            docs = scratch.outside(stage(spark, docs, sf_dir))
    return docs

"""From raw documents to packed training batches, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept: toxic documents
go, one document of each group of near duplicates stays, documents with benchmark passages go,
personal data is masked, and what is left is cut and dealt into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import decontam, nearcopies, packing, pii, toxicity
from orderlake.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = toxicity.learnable(table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return pii.redact(docs).withColumn("n_chars", length)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).rows


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("contamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack_batches),
]

# Letter models and fingerprints are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data directory, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality, near-duplicates, personal data, source mix and packing, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import common, mixing, near_dup, packing, pii, quality
from granary.llm.queries import PII_KEY, table, tokenizer_file


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.7 or more. Without usable labels all stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model, at_least=0.7)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dup.one_of_each(docs, percent=80)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal values replaced, and n_chars counted anew where the text changed."""
    before = common.fresh(docs, "__before")
    out = pii.pseudonymised(docs.withColumn(before, F.col("text")), PII_KEY)
    n_chars = F.when(F.col("text").eqNullSafe(F.col(before)), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that sources come near their target shares."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes, in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file(), size=2048, end=0)


STAGES = [("quality", classify), ("near_duplicates", deduplicate), ("pii", pseudonymise), ("mix", mix), ("packing", pack)]

#: No stage's decisions can be written in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``.

    Each stage's result is a table in the shared folder, which goes when the next one's is written; that before the
    last stage stays, as the rows returned are read from it.
    """
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{folder}/{i}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                common.remove(spark, before)
            before = path
    return docs

"""The corpus pipeline: toxic documents go, hosts' boilerplate lines go, one of each group of near
duplicates stays, sources are mixed to target weights, and what is left is packed into bins.

Each stage is `(spark, docs, sf_dir) -> DataFrame`; it works on all that its predecessor
kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leafmill.llm import jaccard, lines, mixing, packing, toxicity  # noqa: E402
from leafmill.llm.common import stored  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a host's pages go; the documents stay, and `n_chars` follows their texts."""
    return lines.without_boilerplate(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more the one with the least id stays."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source as often as its weight asks for."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins of 2048 words."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

# The classifier, the similarity join and the packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

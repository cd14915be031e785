"""One query per operator, over its whole table: `(spark, sf_dir) -> DataFrame`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import alignment, debruijn, jaccard, lines, mixing, packing, pseudonyms, quality, sharding, toxicity, warc, whitening, winnowing

# A real run passes a secret of its own.
PSEUDONYM_KEY = "corpus"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    return quality.judged(documents(spark, sf_dir))


@query
def op2_mixing(spark, sf_dir):
    return mixing.mixture(documents(spark, sf_dir))


@query
def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(documents(spark, sf_dir))


@query
def op4_winnowing(spark, sf_dir):
    return winnowing.fingerprints(documents(spark, sf_dir))


@query
def op5_substring_dedup(spark, sf_dir):
    return debruijn.without_repeats(documents(spark, sf_dir))


@query
def op6_warc(spark, sf_dir):
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op7_line_dedup(spark, sf_dir):
    return lines.line_report(documents(spark, sf_dir))


@query
def op8_pseudonyms(spark, sf_dir):
    return pseudonyms.pseudonyms(documents(spark, sf_dir), PSEUDONYM_KEY)


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op10_best_fit_packing(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir))


@query
def op11_cross_tokenizer_alignment(spark, sf_dir):
    return alignment.link_report(documents(spark, sf_dir))


@query
def op12_sharding(spark, sf_dir):
    return sharding.placements(documents(spark, sf_dir))


@query
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

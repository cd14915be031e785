"""JSONL page exports: one object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import body_text
from leafmill.operators.landing import coerce_pages
from leafmill.schemas import JSONL_PAGE


def read_jsonl(spark: SparkSession, path: str, default_spider: str, now: Column | None = None) -> DataFrame:
    """Typed raw rows of an export; blank lines are skipped, a malformed line fails the read."""
    lines = spark.read.schema(JSONL_PAGE).option("mode", "FAILFAST").json(path)
    return coerce_pages(lines, default_spider, now)


def stream_jsonl(spark: SparkSession, path: str, default_spider: str, bytes_per_batch: int = 64 << 30) -> DataFrame:
    """The same as a stream of newly arriving files, so many bytes of them at a time."""
    reader = spark.readStream.schema(JSONL_PAGE).option("mode", "FAILFAST")
    return coerce_pages(reader.option("maxBytesPerTrigger", bytes_per_batch).json(path), default_spider)


def append_jsonl(pages: DataFrame, path: str) -> None:
    """Append pages to an export, one folder per spider; bodies as text, non-ASCII kept."""
    names = [c for c in JSONL_PAGE.names if c in pages.columns]
    rows = pages.select(*names).withColumn("body", body_text(F.col("body")))
    if dict(rows.dtypes).get("payload") == "string":
        # The payload is an object in the line, not a quoted string, unless it is no JSON.
        rows = rows.withColumn("payload", F.coalesce(F.try_parse_json("payload"), F.col("payload").cast("variant")))
    folder = F.coalesce(F.nullif("spider", F.lit("")), F.lit("unknown")).alias("site")
    rows.select("*", folder).write.mode("append").partitionBy("site").json(path)

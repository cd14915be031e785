"""HTML files on disk as pages; Spark passes over files without any content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import body_text

# Spark's own columns of whole files; a stream has to be told.
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _pages(files: DataFrame, spider: str, url_prefix: str) -> DataFrame:
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.html$", "")
    return files.select(
        F.lit(spider).alias("spider"),
        F.concat(F.lit(url_prefix), name).alias("url"),
        body_text(F.col("content")).alias("body"),
        F.col("modificationTime").alias("fetched_at"),
    )


def read_saved_pages(spark: SparkSession, path: str, spider: str, url_prefix: str) -> DataFrame:
    """One page per file (spider, url, body, fetched_at); the URL is the prefix and the file's name without `.html`."""
    return _pages(spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path), spider, url_prefix)


def stream_saved_pages(spark: SparkSession, path: str, spider: str, url_prefix: str, bytes_per_batch: int = 64 << 30) -> DataFrame:
    """The same as a stream of newly arriving files, so many bytes of them at a time; a file counts once, whatever is written to it later."""
    files = spark.readStream.schema(FILES).format("binaryFile").option("pathGlobFilter", "*.html")
    return _pages(files.option("maxBytesPerTrigger", bytes_per_batch).load(path), spider, url_prefix)

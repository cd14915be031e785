"""The same work as streams: files are tracked by the checkpoint, so nothing is read twice or missed.

Streams and batch jobs share their tables and their file layout. A batch that was cut off
between writing and committing is written again, under names that checkpoint and batch
number give, in place of what its first run left. Only the columns that are needed are
read, once, and what a batch read and wrote is observed while it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators.incremental import extract_batch
from leafmill.schemas import RAW_TABLE
from leafmill.sites.base import SitePack
from leafmill.sources.jsonl import stream_jsonl
from leafmill.sources.saved_pages import stream_saved_pages
from leafmill.sources.tables import append_batch, batch_label, land_batch, living

# Input of one batch; a batch is one distributed job, so it should keep a whole cluster busy.
BYTES_PER_BATCH = 64 << 30


def stream_raw(spark: SparkSession, raw_path: str, bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """The raw table as a stream of landed files, without rows past the last expiry."""
    return living(spark.readStream.schema(RAW_TABLE).option("maxBytesPerTrigger", bytes_per_batch).parquet(raw_path), raw_path)


def start_parse(
    spark: SparkSession,
    raw_path: str,
    parsed_path: str,
    checkpoint: str,
    pack: SitePack,
    bytes_per_batch: int = BYTES_PER_BATCH,
    batches_path: str | None = None,
    errors_path: str | None = None,
) -> StreamingQuery:
    """Extract every raw file landed since the last run and stop. A fresh checkpoint replays all.

    `batches_path` names a table that gets a row per batch: pages, records and the newest
    fetch time among them. `errors_path` names one for pages that cannot be split, which
    fail the stream otherwise.
    """

    def write(pages: DataFrame, batch: int) -> None:
        read, records, newest = extract_batch(pages, parsed_path, pack, batch_label(checkpoint, batch), errors_path)
        if batches_path is not None and read:
            append_batch(pages.sparkSession, batches_path, pack.name, checkpoint, batch, read, records, newest)

    mine = stream_raw(spark, raw_path, bytes_per_batch).filter(F.col("spider") == pack.name)
    stream = mine.select("spider", "url", "body", "fetched_at")
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_landing(
    spark: SparkSession,
    jsonl_path: str,
    raw_path: str,
    checkpoint: str,
    default_spider: str,
    bytes_per_batch: int = BYTES_PER_BATCH,
    pack: SitePack | None = None,
) -> StreamingQuery:
    """Land every export file that arrived since the last run and stop; `pack` as in `append_raw`."""
    pages = stream_jsonl(spark, jsonl_path, default_spider, bytes_per_batch)
    write = pages.writeStream.foreachBatch(lambda rows, batch: land_batch(rows, raw_path, batch_label(checkpoint, batch), pack))
    return write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_saved_landing(
    spark: SparkSession,
    files_path: str,
    raw_path: str,
    checkpoint: str,
    pack: SitePack,
    url_prefix: str,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> StreamingQuery:
    """Land every saved page that arrived since the last run and stop; a page that was saved had been answered with 200."""
    pages = stream_saved_pages(spark, files_path, pack.name, url_prefix, bytes_per_batch).select(
        "fetched_at",
        "spider",
        "url",
        F.lit(200).alias("http_status"),
        F.create_map().cast("map<string,string>").alias("headers"),
        "body",
        F.lit("{}").alias("payload"),
    )
    write = pages.writeStream.foreachBatch(lambda rows, batch: land_batch(rows, raw_path, batch_label(checkpoint, batch), pack))
    return write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

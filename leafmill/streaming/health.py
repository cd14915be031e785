"""Daily health as a stream: days are event-time windows whose counts are kept until the watermark has passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators.landing import month_of
from leafmill.plans.health import _counts, classified
from leafmill.schemas import RAW_TABLE
from leafmill.sites.base import SitePack
from leafmill.sources.tables import batch_label, living, publish_batch

# How much older than the newest fetch a page may be and still be counted.
DELAY = "7 days"
# Parts that the state is kept in. It holds a row per open day, however many pages: a part for each of the session's
# shuffle partitions would cost every batch a task and a file for each, most of them without a row.
STATE_PARTS = 8
_PARTITIONS = "spark.sql.shuffle.partitions"


def start_health(
    spark: SparkSession, raw_path: str, path: str, checkpoint: str, pack: SitePack, delay: str = DELAY, files_per_batch: int = 10_000
) -> StreamingQuery:
    """Count what was landed since the last run into the table at `path` and stop.

    Each batch writes the days it changed, in place of what an earlier run of it wrote.
    Bodies are not read. State is a row per open day; rows of closed days are dropped.
    """
    raw = living(spark.readStream.schema(RAW_TABLE).option("maxFilesPerTrigger", files_per_batch).parquet(raw_path), raw_path)
    days = classified(raw, pack).withWatermark("fetched_at", delay).groupBy(F.window("fetched_at", "1 day"))
    counted = days.agg(*_counts("pages_fetched"), F.approx_count_distinct("auction_id").alias("about_auctions_touched"))
    named = counted.withColumn("fetch_date", F.to_date("window.start")).drop("window")

    def write(rows: DataFrame, batch: int) -> None:
        dated = rows.withColumns({"batch": F.lit(batch).cast("long"), "fetch_month": month_of(F.col("fetch_date").cast("timestamp"))})
        # The days of a month come from all parts of the state and go to one file.
        publish_batch(dated.repartition("fetch_month"), path, "fetch_month", batch_label(checkpoint, batch))

    stream = named.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    before = spark.conf.get(_PARTITIONS)
    # A stream takes the session's settings as it starts; one that goes on keeps the parts that its checkpoint names.
    spark.conf.set(_PARTITIONS, STATE_PARTS)
    try:
        return stream.start()
    finally:
        spark.conf.set(_PARTITIONS, before)


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """The newest counts of each day."""
    rows = spark.read.parquet(path).drop("fetch_month")
    rest = [c for c in rows.columns if c not in ("fetch_date", "batch")]
    newest = rows.groupBy("fetch_date").agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return newest.select("fetch_date", "last.*")

"""The raw, parsed and progress tables as Parquet."""

from __future__ import annotations

import hashlib
import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.functions.text import utc_literal
from leafmill.operators.landing import decoded, landed, month_of
from leafmill.operators.quality import with_disposition, with_verdict
from leafmill.operators.versions import RETENTION, latest_versions, unexpired, with_content_key
from leafmill.schemas import BATCH_TABLE, ERROR_TABLE, PARSED_TABLE, PROGRESS_TABLE, RAW_TABLE
from leafmill.sites.base import SitePack


def _raw_rows(pages: DataFrame, pack: SitePack | None) -> DataFrame:
    rows = landed(pages, pack=pack) if "fetch_month" not in pages.columns else pages.select(*RAW_TABLE.names)
    return rows.sortWithinPartitions("fetch_month", "spider", "fetched_at")


def land_batch(pages: DataFrame, path: str, label: str, pack: SitePack | None = None) -> None:
    """`append_raw` for a batch that may be run again: its rows are in the table once."""
    publish_batch(_raw_rows(pages, pack), path, "fetch_month", label)


def append_raw(pages: DataFrame, path: str, pack: SitePack | None = None) -> None:
    """Append raw rows by fetch month, sorted so that a site's time range skips row groups.

    No shuffle: bodies stay in the partition they were read in. `pack` is a site of one's
    own, whose marker is noted as those of the registered sites are.
    """
    _raw_rows(pages, pack).write.mode("append").partitionBy("fetch_month").parquet(path)


def append_routed(pages: DataFrame, pack: SitePack, path: str) -> None:
    """Inflate, decode and judge captured pages and store each under its disposition, in one pass over the bodies.

    Bodies may be bytes, compressed or not, or text. `path/disposition=accept` is then a
    raw table for `read_raw`; the other folders hold what to request again, what to give
    up on, and answers that are no pages. A folder is there once a page went into it;
    `read_routed` reads them all.
    """
    judged = with_disposition(with_verdict(decoded(pages), pack), pack.retry_times)
    rows = landed(judged, "reason", "disposition", pack=pack)
    ordered = rows.sortWithinPartitions("disposition", "fetch_month", "spider", "fetched_at")
    ordered.write.mode("append").partitionBy("disposition", "fetch_month").parquet(path)


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    """Everything `append_routed` stored, with `reason` and `disposition`."""
    extra = [T.StructField("reason", T.StringType()), T.StructField("disposition", T.StringType())]
    return spark.read.schema(T.StructType(RAW_TABLE.fields + extra)).parquet(path)


def append_parsed(rows: DataFrame, path: str, label: str | None = None) -> None:
    """Append parsed rows, or plain envelopes (spider, url, source_fetched_at, parsed_at, fields).

    Records are small and a batch may touch many months, so they are rebalanced by month:
    files come out well sized, and a month that holds most rows is split, not piled up.
    `label` names a batch that may be run again, and whose rows are then replaced.
    """
    full = rows if "dedup_key" in rows.columns else with_content_key(rows)
    even = full.select(*PARSED_TABLE.names).hint("rebalance", "source_month")
    if label is not None:
        publish_batch(even, path, "source_month", label)
    else:
        even.write.mode("append").partitionBy("source_month").parquet(path)


def append_errors(rows: DataFrame, path: str, label: str | None = None) -> None:
    """Append pages that could not be split; `label` as in `append_parsed`."""
    # One reason is at most some hundred characters, and such pages are few.
    few = rows.select(*ERROR_TABLE.names).hint("rebalance", "source_month")
    if label is not None:
        publish_batch(few, path, "source_month", label)
    else:
        few.write.mode("append").partitionBy("source_month").parquet(path)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """Pages that could not be split; a table that was never written is empty."""
    store, place = _folder(spark, path)
    if not store.exists(place):
        return spark.createDataFrame([], ERROR_TABLE)
    return spark.read.schema(ERROR_TABLE).parquet(path)


def read_raw(spark: SparkSession, path: str, since: datetime | Column | None = None) -> DataFrame:
    """The raw table without rows past the last expiry; `since` is a strict lower bound that prunes months as well as rows. Without an offset it is UTC."""
    raw = living(spark.read.schema(RAW_TABLE).parquet(path), path)
    if since is None:
        return raw
    bound = utc_literal(since) if isinstance(since, datetime) else since
    return raw.filter((F.col("fetched_at") > bound) & (F.col("fetch_month") >= month_of(bound)))


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARSED_TABLE).parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress table; one that was never written is empty."""
    store, place = _folder(spark, path)
    if not store.exists(place):
        return spark.createDataFrame([], PROGRESS_TABLE)
    return spark.read.schema(PROGRESS_TABLE).parquet(path)


def append_progress(spark: SparkSession, path: str, spider: str, *watermarks: str) -> None:
    """Note how far a spider's pages are extracted, step by step; times are text in the session's zone (UTC)."""
    rows = spark.createDataFrame([(w,) for w in watermarks], "watermark string").select(
        F.lit(spider).alias("spider"),
        F.col("watermark").cast("timestamp").alias("watermark"),
        F.current_timestamp().alias("updated_at"),
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def append_batch(
    spark: SparkSession, path: str, spider: str, run: str, batch: int, pages: int, records: int, watermark: str | None
) -> None:
    """Note what a batch of an extraction read and wrote."""
    row = spark.range(1).select(
        F.lit(spider).alias("spider"),
        F.lit(run).alias("run"),
        F.lit(batch).cast("long").alias("batch"),
        F.lit(pages).cast("long").alias("pages"),
        F.lit(records).cast("long").alias("records"),
        F.lit(watermark).cast("timestamp").alias("watermark"),
        F.current_timestamp().alias("finished_at"),
    )
    row.coalesce(1).write.mode("append").parquet(path)


def append_batches(rows: DataFrame, path: str, spider: str, run: str) -> None:
    """Note what batches of an extraction read and wrote: batch, pages, records, and the watermark as text."""
    noted = rows.select(
        F.lit(spider).alias("spider"),
        F.lit(run).alias("run"),
        "batch",
        "pages",
        "records",
        F.col("watermark").cast("timestamp").alias("watermark"),
        F.current_timestamp().alias("finished_at"),
    )
    noted.coalesce(1).write.mode("append").parquet(path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row per spider, run and batch: what was noted last, where a batch was run again."""
    rows = spark.read.schema(BATCH_TABLE).parquet(path)
    rest = [n for n in BATCH_TABLE.names if n not in ("spider", "run", "batch")]
    last = rows.groupBy("spider", "run", "batch").agg(F.max(F.struct("finished_at", *(n for n in rest if n != "finished_at"))).alias("last"))
    return last.select("*", "last.*").select(*BATCH_TABLE.names)


def compact_progress(spark: SparkSession, path: str) -> None:
    """Fold the progress table to each spider's newest row. A run that dies leaves the folded rows beside the old ones, which say the same."""
    files = _files(spark, path)
    if len(files) > 1:
        newest = F.max(F.struct("updated_at", "watermark")).alias("n")
        rows = spark.read.schema(PROGRESS_TABLE).parquet(*files).groupBy("spider").agg(newest)
        rows.select("spider", "n.watermark", "n.updated_at").coalesce(1).write.mode("append").parquet(path)
        _delete(spark, files)


# Batches that may be run again. Their files are written aside and then moved into the table under names that the
# batch alone gives; files of those names that an earlier run left are removed first. So a batch is in the table
# once, however often it ran, and a stream that reads the table knows the files by their names.


# What has a meaning of its own in a path that names several files.
_GLOB = re.compile(r"[\\*?\[\]{}]")


def publish_batch(rows: DataFrame, path: str, month: str, label: str) -> None:
    """Write rows partitioned by month into the table, as the files `label-…`, in place of what is there under that label."""
    spark = rows.sparkSession
    aside = f"{path}/_batches/{label}"
    rows.write.mode("overwrite").partitionBy(month).parquet(aside)
    store, left = _folder(spark, f"{_GLOB.sub(r'\\\g<0>', path)}/{month}=*/{label}-*")
    # One call for all months: a table gets more of them with every batch.
    _delete(spark, [f.getPath().toString() for f in store.globStatus(left)])
    for value, folder in _folders(spark, aside, month).items():
        for n, name in enumerate(_files(spark, folder)):
            store, target = _folder(spark, f"{path}/{month}={value}/{label}-{n:05d}.parquet")
            store.mkdirs(target.getParent())
            if not store.rename(_folder(spark, name)[1], target):
                raise OSError(f"{name} could not be moved to {target}")
    delete_folder(spark, aside)


def batch_label(checkpoint: str, batch: int) -> str:
    """The name of a stream's batch in the files it writes."""
    return f"batch-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{batch:09d}"


# Maintenance of tables by their path. Parsed months are rewritten by appending their new files and then deleting
# exactly the files that were read: rows landed meanwhile stay, a run that dies leaves repeats and no gaps, and
# `latest_versions` folds the repeats. Nothing folds raw rows, and streams take every new file for new pages, so
# raw files are never rewritten: they are deleted whole, and expired rows among living ones are left out on reading.


def create_table(spark: SparkSession, name: str, schema: T.StructType, month: str, location: str | None = None) -> None:
    """Register a table; months that were landed at its location before are found."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({month}){place}")
    if location:
        spark.catalog.recoverPartitions(name)


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _folders(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """A table's partitions and their folders, from one listing."""
    store, place = _folder(spark, path)
    if not store.exists(place):
        return {}
    named = [f.getPath() for f in store.listStatus(place) if f.getPath().getName().startswith(f"{column}=")]
    return {p.getName().split("=", 1)[1]: p.toString() for p in named}


def _months(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """The months a table holds and their folders; rows without a month are left out."""
    months = _folders(spark, path, column)
    return {m: months[m] for m in sorted(months) if m != "__HIVE_DEFAULT_PARTITION__"}


def _files(spark: SparkSession, folder: str) -> list[str]:
    """A month's data files as they are now."""
    store, place = _folder(spark, folder)
    return sorted(f.getPath().toString() for f in store.listStatus(place) if not f.getPath().getName().startswith(("_", ".")))


def _delete(spark: SparkSession, files: list[str]) -> None:
    for name in files:
        store, place = _folder(spark, name)
        store.delete(place, False)


def _expiries(spark: SparkSession, path: str) -> list[str]:
    store, place = _folder(spark, f"{path}/_expired")
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def living(raw: DataFrame, path: str) -> DataFrame:
    """Rows of the raw table at a path that were not past their time when retention last ran there."""
    marks = _expiries(raw.sparkSession, path)
    # Marks are microseconds of the epoch, all of one length.
    return unexpired(raw, F.timestamp_micros(F.lit(int(marks[-1])))) if marks else raw


def delete_folder(spark: SparkSession, name: str) -> None:
    store, place = _folder(spark, name)
    store.delete(place, True)


def expire_raw(spark: SparkSession, path: str, now: datetime) -> None:
    """Let raw rows past the retention time go: a mark hides them from readers, and files that hold nothing else are deleted.

    What is left on disk beyond its time is less than a month. The mark comes first, so a
    run that dies, or is run again, changes nothing that readers see.
    """
    moment = utc_literal(now)
    edge, mark = spark.range(1).select(month_of(moment - F.expr(RETENTION)).cast("string"), F.unix_micros(moment)).first()
    months = _months(spark, path, "fetch_month")
    if not months:
        return
    store, place = _folder(spark, f"{path}/_expired/{mark:020d}")
    store.create(place, True).close()
    for month, folder in months.items():
        if month < edge:
            _delete(spark, _files(spark, folder))
        elif month == edge and (files := _files(spark, folder)):
            rows = spark.read.schema(RAW_TABLE).option("basePath", path).parquet(*files)
            last = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max("fetched_at").alias("last"))
            # One name per file of one month.
            _delete(spark, [r["file"] for r in last.filter(F.col("last") + F.expr(RETENTION) <= moment).collect()])


def compact_parsed(spark: SparkSession, path: str, months: list[str] | None = None) -> None:
    """Keep only the newest version of each record in the given months, or in all, as one job."""
    held = _months(spark, path, "source_month")
    files = [name for month, folder in held.items() if months is None or month in months for name in _files(spark, folder)]
    if files:
        rows = spark.read.schema(PARSED_TABLE).option("basePath", path).parquet(*files)
        newest = latest_versions(rows).select(*PARSED_TABLE.names).hint("rebalance", "source_month")
        newest.write.mode("append").partitionBy("source_month").parquet(path)
        _delete(spark, files)

"""What is held per URL, kept in a table bucketed by URL, so that work lists are made without a shuffle.

Each landing adds its own URLs with what it learnt of them; a URL's rows of all landings
lie in one bucket, and so do the targets that are asked for, if they are kept the same
way. Bodies are not read where the landing noted the marker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.urls import entry_group
from leafmill.operators.landing import has_marker
from leafmill.operators.links import in_scope
from leafmill.sites.base import SitePack

# Files of a landing. Bucket counts that are multiples of each other still join without a shuffle of the larger table.
BUCKETS = 512


def _append(rows: DataFrame, name: str, buckets: int, path: str | None) -> None:
    # Dealt by bucket, so that a landing adds one file to a bucket and not one per task.
    writer = rows.repartition(buckets, "url").write.bucketBy(buckets, "url").sortBy("url").mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def index_urls(raw: DataFrame, pack: SitePack, name: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Add a site's entry URLs among raw pages to the table `name`: whether any fetch was good, whether any carried the marker.

    A URL fetched any number of times is one row per task before it is shuffled. Adding
    pages again changes no answer. `path` is where a new table's files go; the catalogue's
    own folder if none is given.
    """
    pages = raw.filter(F.col("spider") == pack.name).select(
        "url",
        entry_group(F.col("url"), pack.urls).alias("scope_id"),
        F.col("url").rlike(pack.urls.any_entry).alias("entry"),
        has_marker(raw, pack).alias("marked"),
        (F.col("http_status") == 200).alias("ok"),
    )
    mine = pages.filter(F.col("entry") | F.col("scope_id").isNotNull())
    seen = mine.groupBy("url", "scope_id", "entry").agg(
        F.bool_or(F.coalesce(F.col("ok") & F.col("marked"), F.lit(False))).alias("good"),
        F.bool_or("marked").alias("marked"),
    )
    _append(seen.select(F.lit(pack.name).alias("spider"), *seen.columns), name, buckets, path)


def index_targets(links: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Add the distinct targets of links to the table `name`."""
    _append(links.select(F.col("dst_url").alias("url")).distinct(), name, buckets, path)


def _held(spark: SparkSession, pack: SitePack, name: str, ids: Sequence[str] | DataFrame | None) -> DataFrame:
    rows = spark.table(name).filter(F.col("spider") == pack.name)
    if ids is None:
        return rows.filter("entry")
    return in_scope(rows.filter(F.col("scope_id").isNotNull()), ids)


def good_urls(spark: SparkSession, pack: SitePack, name: str, ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """`good_entries` from the index; no shuffle unless it is limited to some groups."""
    return _held(spark, pack, name, ids).filter("good").select("url").distinct()


def urls_to_heal(spark: SparkSession, pack: SitePack, name: str, ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """`heal_set` from the index; no shuffle unless it is limited to some groups."""
    seen = _held(spark, pack, name, ids).groupBy("url").agg(F.bool_or("marked").alias("ok"))
    return seen.filter(~F.col("ok")).select("url")


def targets_to_fetch(
    spark: SparkSession, pack: SitePack, targets: str, name: str, ids: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """`skip_held` from a table of targets and the index; with equal bucket counts nothing is shuffled."""
    return spark.table(targets).select("url").distinct().join(good_urls(spark, pack, name, ids), "url", "left_anti")

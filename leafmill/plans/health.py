"""Crawl health: volume, errors and page mix, by day and over all time. Bodies are never read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import blank_to_null
from leafmill.functions.urls import group_id, page_type
from leafmill.sites.base import SitePack


def classified(raw: DataFrame, pack: SitePack) -> DataFrame:
    """A site's fetches with their day, page type and auction id."""
    url = F.col("url")
    return raw.filter(F.col("spider") == pack.name).select(
        F.to_date("fetched_at").alias("fetch_date"),
        "fetched_at",
        "url",
        "http_status",
        page_type(url, pack.urls).alias("page_type"),
        blank_to_null(group_id(url, pack.urls)).alias("auction_id"),
    )


def _counts(total: str) -> list[Column]:
    ok, kind = F.col("http_status") == 200, F.col("page_type")
    return [
        F.count("*").alias(total),
        F.count_if(ok).alias("ok_200"),
        F.count_if(~ok).alias("errors"),
        F.bround(F.try_divide(F.count_if(~ok), F.count("*")), 4).alias("error_rate"),
        F.count_if(kind == "lot").alias("lots"),
        F.count_if(kind == "catalog").alias("catalogs"),
        F.count_if(kind == "other").alias("archive_other"),
    ]


def health_daily(raw: DataFrame, pack: SitePack) -> DataFrame:
    days = classified(raw, pack).groupBy("fetch_date")
    distinct = F.count_distinct("auction_id").alias("distinct_auctions_touched")
    return days.agg(*_counts("pages_fetched"), distinct).orderBy("fetch_date")


def health_overall(raw: DataFrame, pack: SitePack) -> DataFrame:
    return classified(raw, pack).agg(
        *_counts("total_pages"),
        F.min("fetched_at").alias("first_fetched_at"),
        F.max("fetched_at").alias("last_fetched_at"),
    )


def health(raw: DataFrame, pack: SitePack) -> DataFrame:
    """`health_daily` and `health_overall` from one scan: a row per day, `level` 'day', and one with the same columns for all time, `level` 'total'.

    Fetches are counted per day and auction first, so that the rollup doubles those few
    rows and not the fetches, and distinct auctions are counted on them at both levels.
    """
    ok, kind, total = F.col("http_status") == 200, F.col("page_type"), F.col("pages_fetched")
    fewer = classified(raw, pack).groupBy("fetch_date", "auction_id").agg(
        F.count("*").alias("pages_fetched"),
        F.count_if(ok).alias("ok_200"),
        F.count_if(~ok).alias("errors"),
        *(F.count_if(kind == k).alias(n) for k, n in (("lot", "lots"), ("catalog", "catalogs"), ("other", "archive_other"))),
        F.min("fetched_at").alias("first_fetched_at"),
        F.max("fetched_at").alias("last_fetched_at"),
    )
    sums = ("pages_fetched", "ok_200", "errors", "lots", "catalogs", "archive_other")
    both = fewer.rollup("fetch_date").agg(
        F.grouping_id().alias("all_days"),
        *(F.sum(n).alias(n) for n in sums),
        F.count_distinct("auction_id").alias("distinct_auctions_touched"),
        F.min("first_fetched_at").alias("first_fetched_at"),
        F.max("last_fetched_at").alias("last_fetched_at"),
    )
    rate = F.bround(F.try_divide(F.col("errors"), total), 4).alias("error_rate")
    level = F.when(F.col("all_days") == 1, "total").otherwise("day").alias("level")
    return both.select(level, "fetch_date", *sums, rate, "distinct_auctions_touched", "first_fetched_at", "last_fetched_at")

"""How much is held: per auction, and in one row over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.records import latest, read_records, sticky_status
from leafmill.functions.text import blank_to_null
from leafmill.functions.urls import group_id
from leafmill.sites.base import SitePack


def group_rollup(parsed: DataFrame, pack: SitePack) -> DataFrame:
    """One row per auction id named by any record, all measures in one scan and one grouping.

    `auctions` counts auction records; a group with none is known from lots alone.
    The distinct count is taken over a value that is null off item rows rather than
    with a filter clause, so rows are not multiplied for it, and its first shuffle is
    on (auction, lot), which keeps a hot auction spread out.
    """
    rows = read_records(parsed, pack.name, ["auction_id", "status", "date_iso", "lot_number"])
    auction, item = F.col("record_type") == "auction", F.col("record_type") == "item"
    return rows.groupBy("auction_id").agg(
        F.count_if(auction).alias("auctions"),
        sticky_status(when=auction).alias("status"),
        F.coalesce(latest("date_iso", auction & (F.col("date_iso") != "")), F.lit("")).alias("date_iso"),
        F.max(F.when(auction, F.col("parsed_at"))).alias("last_parsed_at"),
        F.count_distinct(F.when(item, F.col("lot_number"))).alias("lots_parsed"),
        F.max("parsed_at").alias("last_any_at"),
    )


def auction_rollup(parsed: DataFrame, pack: SitePack) -> DataFrame:
    """One row per auction that has an auction record."""
    return group_rollup(parsed, pack).filter(F.col("auctions") > 0).drop("auctions", "last_any_at")


def lots_per_auction(parsed: DataFrame, pack: SitePack) -> DataFrame:
    """Distinct lots per auction id; lots without a number count as one."""
    items = read_records(parsed, pack.name, ["auction_id", "lot_number"], "item")
    return items.groupBy("auction_id").agg(F.count_distinct("lot_number").alias("lots_parsed"))


def data_overview(parsed: DataFrame, pack: SitePack) -> DataFrame:
    """One row over all auctions."""
    groups = group_rollup(parsed, pack)
    real = F.col("auctions") > 0
    lots = F.when(real, F.col("lots_parsed"))
    completed = F.col("status") == "completed"
    total = F.count_if(real)
    return groups.agg(
        total.alias("total_auctions"),
        F.count_if(real & completed).alias("completed_auctions"),
        F.count_if(real & ~completed).alias("upcoming_auctions"),
        F.coalesce(F.sum(lots), F.lit(0)).alias("total_lots"),
        F.bround(F.avg(lots), 1).alias("avg_lots_per_auction"),
        F.max(lots).alias("max_lots_per_auction"),
        F.count_if(lots > 0).alias("auctions_with_lots"),
        F.count_if(lots == 0).alias("auctions_without_lots"),
        F.bround(F.avg(lots) * total).cast("bigint").alias("estimated_total_lots"),
        F.max("last_any_at").alias("last_parsed_at"),
    )


def fetch_rollup(raw: DataFrame, pack: SitePack) -> DataFrame:
    """Fetches per auction id in the URL; pages outside any auction do not count."""
    pages = raw.filter(F.col("spider") == pack.name).select(
        group_id(F.col("url"), pack.urls).alias("auction_id"), "http_status", "fetched_at"
    )
    return pages.filter(F.col("auction_id") != "").groupBy("auction_id").agg(
        F.count("*").alias("pages_fetched"),
        F.count_if(F.col("http_status") != 200).alias("http_errors"),
        F.max("fetched_at").alias("last_fetched_at"),
    )


def auction_coverage(raw: DataFrame, parsed: DataFrame, pack: SitePack, ordered: bool = True) -> DataFrame:
    """Per auction: what was recorded, what was fetched, and whether paging was missed."""
    joined = auction_rollup(parsed, pack).join(fetch_rollup(raw, pack), "auction_id", "left")
    pages = F.coalesce("pages_fetched", F.lit(0))
    rows = joined.select(
        "auction_id",
        "status",
        "date_iso",
        F.try_to_date(blank_to_null(F.col("date_iso"))).alias("auction_date"),
        "lots_parsed",
        "last_parsed_at",
        pages.alias("pages_fetched"),
        F.coalesce("http_errors", F.lit(0)).alias("http_errors"),
        "last_fetched_at",
        ((F.col("lots_parsed") == pack.urls.entries_per_page) & (pages <= 1)).alias("likely_truncated"),
    )
    # The id as second key lets the sort split a date, or the missing date, that many auctions share.
    return rows.orderBy(F.desc_nulls_last("auction_date"), "auction_id") if ordered else rows

"""Newest version of each record, and rows past their time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.operators.landing import month_of
from leafmill.schemas import PARSED_TABLE

# Fixed value: how long raw pages are kept.
RETENTION = "INTERVAL 6 MONTH"


def with_content_key(parsed: DataFrame) -> DataFrame:
    """Envelope rows (spider, url, source_fetched_at, parsed_at, fields) as full parsed-table rows."""
    read = parsed.select(
        "spider", "url", "source_fetched_at", "parsed_at", F.parse_json("fields").alias("record")
    )
    text = read.select("*", F.to_json("record").alias("fields"))
    return text.select(
        "*",
        F.xxhash64("fields").alias("dedup_key"),
        F.coalesce(F.try_variant_get("record", "$.type", "string"), F.lit("")).alias("record_type"),
        month_of("source_fetched_at").alias("source_month"),
    ).select(*PARSED_TABLE.names)


def latest_versions(parsed: DataFrame) -> DataFrame:
    """One row per month, spider, URL and record content: the one parsed last.

    Grouping by the content itself beside its hash keeps records apart whose hashes
    meet; the hash comes first, so that sorting compares numbers and seldom text. A
    mergeable max, so repeats are folded before the shuffle.
    """
    keys = ["dedup_key", "source_month", "spider", "url", "record_type", "fields"]
    newest = parsed.groupBy(*keys).agg(F.max(F.struct("parsed_at", "source_fetched_at")).alias("v"))
    return newest.select("*", "v.parsed_at", "v.source_fetched_at").select(*PARSED_TABLE.names)


def unexpired(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Raw rows within the retention time; whole months are pruned before they are read."""
    moment = now if now is not None else F.current_timestamp()
    alive = raw.filter(F.col("fetched_at") + F.expr(RETENTION) > moment)
    if "fetch_month" in raw.columns:
        alive = alive.filter(F.col("fetch_month") >= month_of(moment - F.expr(RETENTION)))
    return alive

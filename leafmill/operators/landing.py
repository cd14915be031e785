"""From captured pages to rows of the raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import body_text, utc_time
from leafmill.operators.quality import inflate_bodies
from leafmill.schemas import RAW_TABLE
from leafmill.sites.base import SitePack
from leafmill.sites.registry import get_site, list_sites


def month_of(time: str | Column) -> Column:
    return F.to_date(F.date_trunc("month", time))


def coerce_pages(pages: DataFrame, default_spider: str, now: Column | None = None) -> DataFrame:
    """Rows as JSONL or a crawler give them to typed raw rows, each gap filled with its default.

    Headers may hold one value per name or a list, of which the first counts. Bodies
    given as bytes are inflated where they are still compressed, then decoded.
    """
    headers = F.col("headers")
    if dict(pages.dtypes)["headers"].endswith("array<string>>"):
        headers = F.transform_values(headers, lambda _, v: F.get(v, F.lit(0)))
    when = F.col("fetched_at")
    if dict(pages.dtypes)["fetched_at"] == "string":
        when = utc_time(when, now)
    rows = pages.select(
        F.coalesce(when, now if now is not None else F.current_timestamp()).alias("fetched_at"),
        F.coalesce(F.nullif("spider", F.lit("")), F.lit(default_spider)).alias("spider"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.nullif(F.col("http_status").cast("string"), F.lit("")).cast("double").cast("int"), F.lit(0)).alias(
            "http_status"
        ),
        F.coalesce(
            F.transform_values(headers, lambda _, v: F.coalesce(v, F.lit("None"))),
            F.create_map().cast("map<string,string>"),
        ).alias("headers"),
        "body",
        F.coalesce(F.to_json(F.try_parse_json("payload")), F.nullif("payload", F.lit("")), F.lit("{}")).alias("payload"),
    )
    return decoded(rows)


def decoded(pages: DataFrame) -> DataFrame:
    """Pages with `body` as text: bytes are inflated first where they are still compressed."""
    plain = inflate_bodies(pages) if dict(pages.dtypes)["body"] == "binary" else pages
    return plain.withColumn("body", body_text(F.col("body")))


def landed(pages: DataFrame, *extra: str, pack: SitePack | None = None) -> DataFrame:
    """Raw rows with the derived columns of the raw table, and the named columns of their own.

    The marker is noted for the registered sites, and for `pack`, a site of one's own.
    """
    marker = F.lit(None).cast("boolean")
    for known in [*map(get_site, list_sites()), *([pack] if pack is not None else [])]:
        if known.urls is not None:
            marker = F.when(F.col("spider") == known.name, F.col("body").contains(known.urls.marker)).otherwise(marker)
    return pages.select(
        "*",
        marker.alias("has_marker"),
        F.octet_length("body").alias("body_bytes"),
        month_of("fetched_at").alias("fetch_month"),
    ).select(*RAW_TABLE.names, *extra)


def has_marker(raw: DataFrame, pack: SitePack) -> Column:
    """Whether a stored body carries the site's marker.

    Every landing notes it for registered sites, so their bodies are not read; for other
    sites it may not have been noted, and then the body says.
    """
    looked = F.col("body").contains(pack.urls.marker)
    if "has_marker" not in raw.columns:
        return looked
    if pack.name in list_sites() and get_site(pack.name).urls == pack.urls:
        return F.coalesce("has_marker", F.lit(False))
    return F.coalesce("has_marker", looked, F.lit(False))

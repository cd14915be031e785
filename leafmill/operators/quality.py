"""Which captured pages are usable: inflate, gate, route, sample, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.inflate import GZIP_MAGIC, inflated
from leafmill.functions.urls import file_name
from leafmill.sites.base import SitePack

# Smallest usable body in bytes, sample size, bytes shown of a bad body.
MIN_BODY_BYTES = 500
SAMPLE_ROWS = 20
HEAD_BYTES = 300
NO_MARKER = "lot page missing lot microdata"


def is_page(status: Column | None = None) -> Column:
    """Anything but a 2xx answer is not a page."""
    return (F.col("http_status") if status is None else status).between(200, 299)


def _header(name: str) -> Column:
    found = F.filter(F.map_entries("headers"), lambda h: F.lower(h["key"]) == name)
    return F.get(found, F.lit(0))["value"]


def inflate_bodies(pages: DataFrame) -> DataFrame:
    """Pages with binary `body` inflated where still compressed; their Content-Encoding header goes.

    Only compressed bodies are sent to Python; every other row passes as null.
    """
    encoding = F.lower(F.coalesce(_header("content-encoding"), F.lit("")))
    compressed = (F.substring("body", 1, 2) == F.lit(GZIP_MAGIC)) | encoding.isin("gzip", "deflate", "br")
    asked = is_page() & compressed & (F.octet_length("body") > 0)
    plain = inflated(F.when(asked, F.col("body")), encoding)
    kept = F.map_filter("headers", lambda k, _: F.lower(k) != "content-encoding")
    return (
        pages.withColumn("_plain", plain)
        .withColumn("headers", F.when(F.col("_plain").isNotNull(), kept).otherwise(F.col("headers")))
        .withColumn("body", F.coalesce("_plain", "body"))
        .drop("_plain")
    )


def with_verdict(pages: DataFrame, pack: SitePack) -> DataFrame:
    """Adds `reason` and `retryable`, both null for a usable page or one the gate does not judge."""
    bytes_ = F.octet_length("body")
    verdict = F.when(
        bytes_ < MIN_BODY_BYTES,
        F.struct(
            F.concat(F.lit("empty/short body ("), bytes_.cast("string"), F.lit(" bytes)")).alias("reason"),
            F.lit(True).alias("retryable"),
        ),
    )
    if pack.urls is not None:
        marker = pack.urls.marker
        marked = F.col("body").contains(
            F.lit(marker.encode()) if dict(pages.dtypes)["body"] == "binary" else F.lit(marker)
        )
        verdict = verdict.when(
            F.col("url").rlike(pack.urls.entry_page) & ~marked,
            F.struct(F.lit(NO_MARKER).alias("reason"), F.lit(False).alias("retryable")),
        )
    judged = is_page() & ~F.col("url").endswith("/robots.txt")
    return pages.withColumn("_v", F.when(judged, verdict)).select("*", "_v.reason", "_v.retryable").drop("_v")


def with_disposition(gated: DataFrame, max_retries: int) -> DataFrame:
    """Adds `disposition`: pass (not a page), accept, retry or drop.

    `retry_times` counts the retries a page already had; without that column it is 0.
    """
    tried = F.coalesce("retry_times", F.lit(0)) if "retry_times" in gated.columns else F.lit(0)
    return gated.withColumn(
        "disposition",
        F.when(~is_page(), "pass")
        .when(F.col("reason").isNull(), "accept")
        .when(F.col("retryable") & (tried < max_retries), "retry")
        .otherwise("drop"),
    )


def route(pages: DataFrame, pack: SitePack) -> dict[str, DataFrame]:
    """Gate a site's pages and split them by disposition.

    Each part is its own plan over the pages; to store all of them use
    `sources.tables.append_routed`, which reads the bodies once.
    """
    judged = with_disposition(with_verdict(pages, pack), pack.retry_times)
    return {name: judged.filter(F.col("disposition") == name) for name in ("pass", "accept", "retry", "drop")}


def bad_sample(gated: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The earliest bad pages, with what is needed to see why they are bad."""
    picked = gated.filter(F.col("reason").isNotNull()).select(
        "fetched_at",
        "url",
        "reason",
        F.coalesce(_header("content-type"), F.lit("")).alias("content_type"),
        F.octet_length("body").alias("body_bytes"),
        F.hex(F.substring(F.col("body").cast("binary"), 1, HEAD_BYTES)).alias("head_hex"),
        F.concat(file_name(F.col("url"), 120), F.lit("__"), file_name(F.col("reason"), 60)).alias("sample_name"),
    )
    return picked.orderBy("fetched_at", "url", "reason").limit(rows)


def quarantine_report(gated: DataFrame) -> DataFrame:
    """Bad pages by reason."""
    return gated.filter(F.col("reason").isNotNull()).groupBy("reason", "retryable").agg(F.count("*").alias("pages"))

"""Pages to records: one flat-map job, one nodes column, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.markup import page_nodes, page_nodes_or_error
from leafmill.functions.text import body_text
from leafmill.schemas import PARSED_TABLE
from leafmill.sites.base import SitePack
from leafmill.sites.registry import get_site


def _pack(site: str | SitePack) -> SitePack:
    pack = get_site(site) if isinstance(site, str) else site
    if pack.extract is None:
        raise ValueError(f"site {pack.name!r} defines no extraction")
    return pack


@lru_cache(maxsize=64)
def _extraction(pack: SitePack, app: str) -> Column:
    """The pack's record expression; building it takes many calls to the JVM, so once per application."""
    return pack.extract(F.col("_nodes"), F.col("url"))


def _with_nodes(pages: DataFrame, pack: SitePack) -> DataFrame:
    return pages.withColumn("_nodes", page_nodes(body_text(F.col("body")), F.col("url"), pack.attributes, marks=pack.marks))


def page_records(pages: DataFrame, site: str | SitePack) -> DataFrame:
    """`pages` (url, body and whatever else) with each page's records as array `records`, null for none.

    Narrow the input to the columns wanted before calling: filters and pruning do not
    pass through the Python step on their own.
    """
    pack = _pack(site)
    found = _extraction(pack, pages.sparkSession.sparkContext.applicationId)
    return _with_nodes(pages, pack).withColumn("records", found).drop("_nodes", "body")


def explode_records(pages: DataFrame, site: str | SitePack) -> DataFrame:
    """`pages` without the body, one row per record in `record`.

    The expression is exploded as it stands. Over a named column Spark would infer a
    filter on the array, push it down and work the extraction out a second time.
    """
    pack = _pack(site)
    found = _extraction(pack, pages.sparkSession.sparkContext.applicationId)
    kept = [c for c in pages.columns if c != "body"]
    return _with_nodes(pages, pack).select(*kept, F.explode(found).alias("record"))


def _envelopes(found: DataFrame, pack: SitePack, parsed_at: Column | None, *extra: str) -> DataFrame:
    names = sorted(found.schema["record"].dataType.names)
    # Fields in key order make the text canonical as it is written.
    fields = F.to_json(F.struct(*(F.col("record")[n].alias(n) for n in names)))
    rows = found.select(
        F.lit(pack.name).alias("spider"),
        "url",
        F.col("fetched_at").alias("source_fetched_at"),
        (parsed_at if parsed_at is not None else F.current_timestamp()).alias("parsed_at"),
        fields.alias("fields"),
        (F.col("record")["type"] if "type" in names else F.lit("")).alias("record_type"),
        F.to_date(F.date_trunc("month", "fetched_at")).alias("source_month"),
        *extra,
    )
    return rows.withColumn("dedup_key", F.xxhash64("fields")).select(*PARSED_TABLE.names, *extra)


def _site_pages(raw: DataFrame, pack: SitePack) -> DataFrame:
    return raw.filter(F.col("spider") == pack.name).select("url", "body", "fetched_at")


def parse_pages(raw: DataFrame, site: str | SitePack, parsed_at: Column | None = None) -> DataFrame:
    """Rows for the parsed table from a site's raw pages. A page that cannot be split fails the job."""
    pack = _pack(site)
    return _envelopes(explode_records(_site_pages(raw, pack), pack), pack, parsed_at)


def parse_or_error(raw: DataFrame, site: str | SitePack, parsed_at: Column | None = None) -> DataFrame:
    """`parse_pages`' rows with `error` null, and for each page that cannot be split one row without fields and with the reason.

    Only the splitting of a page is guarded; a pack whose own expression raises an error
    on some value (a strict cast, say) still fails the job.
    """
    pack = _pack(site)
    split = page_nodes_or_error(body_text(F.col("body")), F.col("url"), pack.attributes, pack.marks)
    pages = _site_pages(raw, pack).withColumn("_split", split)
    pages = pages.select("url", "fetched_at", F.col("_split")["nodes"].alias("_nodes"), F.col("_split")["error"].alias("error"))
    found = _extraction(pack, raw.sparkSession.sparkContext.applicationId)
    # The outer form keeps pages without records; the filter needs what was exploded, so it cannot be pushed below.
    rows = pages.select("url", "fetched_at", "error", F.explode_outer(F.when(F.col("error").isNull(), found)).alias("record"))
    told = rows.filter(F.col("record").isNotNull() | F.col("error").isNotNull())
    rows = _envelopes(told, pack, parsed_at, "error")
    return rows.withColumn("fields", F.when(F.col("error").isNull(), F.col("fields")))


def parse_sites(raw: DataFrame, sites: Sequence[str], parsed_at: Column | None = None) -> DataFrame:
    """Parsed rows of several sites, each by its own pack; unknown sites fail before anything runs."""
    packs = [_pack(site) for site in sites]
    return reduce(DataFrame.unionAll, [parse_pages(raw, pack, parsed_at) for pack in packs])


def page_yield(raw: DataFrame, site: str | SitePack) -> DataFrame:
    """Records per fetched page; pages that gave none are kept with 0."""
    pack = _pack(site)
    counted = page_records(_site_pages(raw, pack), pack)
    return counted.select("url", "fetched_at", F.coalesce(F.size("records"), F.lit(0)).alias("records"))

"""Work tables for a crawler: what is held, what is missing, what comes next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.records import read_records
from leafmill.functions.urls import canonical_url, distinct_ids, entry_group
from leafmill.operators.landing import has_marker
from leafmill.operators.links import in_scope, page_links, unique_requests
from leafmill.session import scratch_table
from leafmill.sites.base import SitePack

# Fixed value: archive pages walked at most.
MAX_ARCHIVE_PAGES = 10
_PAGE = 1 << 32


def _entry_pages(raw: DataFrame, pack: SitePack, ids: Sequence[str] | DataFrame | None) -> DataFrame:
    """A site's stored entry pages as (url, http_status, marked), limited to some groups when given."""
    pages = raw.filter(F.col("spider") == pack.name).select(
        "url",
        "http_status",
        has_marker(raw, pack).alias("marked"),
        entry_group(F.col("url"), pack.urls).alias("scope_id"),
    )
    if ids is None:
        return pages.filter(F.col("url").rlike(pack.urls.any_entry))
    return in_scope(pages.filter(F.col("scope_id").isNotNull()), ids)


def good_entries(raw: DataFrame, pack: SitePack, ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Entry URLs held in good shape: fetched with status 200 and the marker in the body."""
    pages = _entry_pages(raw, pack, ids)
    return pages.filter((F.col("http_status") == 200) & F.col("marked")).select("url").distinct()


def skip_held(
    links: DataFrame, raw: DataFrame, pack: SitePack, ids: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Distinct link targets still to fetch. Only good entries are dropped; group pages and paging stay.

    Both sides are distinct before they meet, so a link on every page costs one row.
    """
    wanted = links.select(F.col("dst_url").alias("url")).distinct()
    return wanted.join(good_entries(raw, pack, ids), "url", "left_anti")


def heal_set(raw: DataFrame, pack: SitePack, ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Entry URLs fetched before, none of whose stored bodies, whatever the status, carries the marker."""
    pages = _entry_pages(raw, pack, ids)
    return pages.groupBy("url").agg(F.bool_or("marked").alias("ok")).filter(~F.col("ok")).select("url")


def fetch_outcome(targets: DataFrame, raw: DataFrame, pack: SitePack) -> DataFrame:
    """One row: URLs targeted, how many are now held in good shape, how many are missing."""
    good = good_entries(raw, pack).withColumn("good", F.lit(True))
    joined = targets.select("url").distinct().join(good, "url", "left")
    total, ok = F.count("*"), F.count("good")
    return joined.agg(
        total.alias("targeted"), ok.alias("fetched_ok"), F.greatest(total - ok, F.lit(0)).alias("still_missing")
    )


def latest_ids(archive: DataFrame, pack: SitePack, n: int, max_pages: int = MAX_ARCHIVE_PAGES) -> DataFrame:
    """The first `n` ids of archive pages (page, html) read in order, as (rank, auction_id).

    Reading ends at the first page that adds no new id, or that is not there.
    """
    pages = archive.filter(F.col("page").between(1, max_pages))
    seen = pages.select("page", F.posexplode(distinct_ids(F.col("html"), pack.urls)).alias("pos", "auction_id"))
    # Page and position in one number, so that the first sighting is a plain hash aggregate.
    place = F.col("page").cast("bigint") * _PAGE + F.col("pos")
    first = seen.groupBy("auction_id").agg(F.min(place).alias("place"))
    new = first.groupBy(F.expr(f"place div {_PAGE}").alias("page")).agg(F.count("*").alias("new"))
    every = archive.sparkSession.range(1, max_pages + 1).withColumnRenamed("id", "page")
    stop = every.join(new, "page", "left_anti").agg(F.coalesce(F.min("page"), F.lit(max_pages + 1)).alias("stop"))
    kept = first.filter(F.col("place") < stop.scalar() * _PAGE)
    top = kept.orderBy("place").limit(n)
    return top.select(F.row_number().over(Window.orderBy("place")).alias("rank"), "auction_id")


def stored_ids(parsed: DataFrame, pack: SitePack, completed_only: bool = True) -> DataFrame:
    """Auction ids with a record, or only those ever recorded as completed."""
    records = read_records(parsed, pack.name, ["auction_id", "status"], "auction")
    if completed_only:
        records = records.filter(F.col("status") == "completed")
    return records.filter(F.col("auction_id") != "").select("auction_id").distinct()


def work_plan(candidates: DataFrame, stored: DataFrame | None, held: bool = False) -> DataFrame:
    """Candidates (rank, auction_id) still to fetch, in rank order; `held` gives those skipped instead.

    Without a store everything is still to fetch.
    """
    if stored is None:
        return candidates.limit(0) if held else candidates.orderBy("rank")
    return candidates.join(stored, "auction_id", "left_semi" if held else "left_anti").select(
        "rank", "auction_id"
    ).orderBy("rank")


def seeds(ids: DataFrame, pack: SitePack) -> DataFrame:
    """The page each group's crawl starts from."""
    return ids.select("auction_id", F.format_string(pack.urls.seed, "auction_id").alias("url"))


def start_pages(like: DataFrame, pack: SitePack) -> DataFrame:
    """The site's own start pages."""
    return like.sparkSession.createDataFrame([(u,) for u in pack.start_urls], "url string")


def frontier_step(pages: DataFrame, pack: SitePack, known: DataFrame) -> DataFrame:
    """New targets linked from `pages` by the site's rules, minus the `known` URLs.

    Spellings of one request (order of the query, fragment, percent-encoding) are one
    target, of which one is kept, and a known one hides them all.
    """
    wanted = unique_requests(page_links(pages, pack.rules, pack.domains), "dst_url")
    seen = known.select(canonical_url(F.col("url")).alias("canonical_url")).distinct()
    return wanted.join(seen, "canonical_url", "left_anti").select("url")


def crawl(pages: DataFrame, pack: SitePack, seeds: DataFrame) -> DataFrame:
    """What a crawl from `seeds` reaches over a snapshot of pages: canonical_url, url (a spelling of it) and depth, the fewest links from a seed.

    Pages are split into links once. Each round joins the links with what the round before
    reached and takes off what is known; rounds end when nothing is new, so there are as
    many as the longest shortest path. Targets without a page in the snapshot are reached
    and lead nowhere. What a round reaches is distinct in every task before it is shuffled,
    so a target that all pages link to is no burden.
    """
    source, target = (canonical_url(F.col(c)) for c in ("src_url", "dst_url"))
    found = page_links(pages, pack.rules, pack.domains).select(source.alias("source"), target.alias("canonical_url"), F.col("dst_url").alias("url"))
    edges = scratch_table(found.groupBy("source", "canonical_url").agg(F.min("url").alias("url")), "crawl-edges")
    spelled = seeds.select(canonical_url(F.col("url")).alias("canonical_url"), "url")
    now = scratch_table(spelled.groupBy("canonical_url").agg(F.min("url").alias("url")).withColumn("depth", F.lit(0)), "crawl-reached")
    reached = now
    depth = 0
    while not now.isEmpty():
        depth += 1
        targets = edges.join(now.select(F.col("canonical_url").alias("source")), "source").groupBy("canonical_url").agg(F.min("url").alias("url"))
        new = targets.join(reached.select("canonical_url"), "canonical_url", "left_anti")
        now = scratch_table(new.withColumn("depth", F.lit(depth)), "crawl-reached")
        reached = reached.unionAll(now)
    return reached

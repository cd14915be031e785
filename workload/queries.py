"""One query per operator, each over whole tables: `(spark, sf_dir) -> DataFrame`."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as tx
from leafmill.functions import urls as ux
from leafmill.functions.records import canonical_json
from leafmill.functions.sql import register_page_blocks
from leafmill.operators import extract, incremental, landing, links, quality, url_index, versions, worklists
from leafmill.plans import coverage, health, items, views
from leafmill.session import scratch_path
from leafmill.sites.base import LinkRules
from leafmill.sites.registry import get_site
from leafmill.sources import jsonl, states, tables
from leafmill.streaming import drain as streams
from leafmill.streaming import health as health_streams
from leafmill.streaming import requests
from workload import fixtures as fx
from workload.fixtures import PACK

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = "2024-08-01 00:00:00"
RETENTION_NOW = "2024-07-04 00:00:00"
REPLAY_SINCE = "2024-01-02 06:00:00"
BATCH = 152


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def at(time: str):
    return F.lit(time).cast("timestamp")


def joined_images(rows: DataFrame) -> DataFrame:
    return rows.withColumn("images", F.array_join("images", ","))


# Report views.


@query
def item_facts(spark, sf_dir):
    numbers = {n: F.col(n).cast("bigint") for n in ("start_price", "leading_bid", "final_price", "views")}
    return joined_images(items.item_facts(fx.parsed_records(spark, sf_dir), PACK)).withColumns(numbers)


@query
def overview(spark, sf_dir):
    return coverage.data_overview(fx.parsed_records(spark, sf_dir), PACK)


@query
def auction_status_sticky(spark, sf_dir):
    return coverage.auction_rollup(fx.parsed_records(spark, sf_dir), PACK).drop("lots_parsed")


@query
def lots_per_auction(spark, sf_dir):
    return coverage.lots_per_auction(fx.parsed_records(spark, sf_dir), PACK)


@query
def auction_coverage(spark, sf_dir):
    return coverage.auction_coverage(fx.raw_pages(spark, sf_dir), fx.parsed_records(spark, sf_dir), PACK)


@query
def truncation_flag(spark, sf_dir):
    """Lots copied up to 36 per auction, so that the flag is met by some auctions and just missed by others."""
    orders = fx.dealt(fx.table(spark, sf_dir, "orders").select("o_orderkey"))
    count = (F.col("o_orderkey") % 3 + 35).cast("int")
    lots = orders.select(F.col("o_orderkey"), F.explode(F.sequence(F.lit(1), count)).alias("lot"))
    record = F.struct(
        F.lit("item").alias("type"), fx.text("o_orderkey").alias("auction_id"), fx.text("lot").alias("lot_number")
    )
    envelope = lots.select(
        F.lit(PACK.name).alias("spider"),
        F.lit("u").alias("url"),
        at(NOW).alias("source_fetched_at"),
        at(NOW).alias("parsed_at"),
        F.to_json(record).alias("fields"),
        F.lit("item").alias("record_type"),
    )
    parsed = fx.auction_records(spark, sf_dir).unionAll(envelope)
    rows = coverage.auction_coverage(fx.raw_pages(spark, sf_dir), parsed, PACK, ordered=False)
    return rows.select("auction_id", "lots_parsed", "pages_fetched", "likely_truncated")


@query
def fetch_rollup(spark, sf_dir):
    return coverage.fetch_rollup(fx.raw_pages(spark, sf_dir), PACK)


@query
def page_type(spark, sf_dir):
    return health.classified(fx.raw_pages(spark, sf_dir), PACK).select("url", "fetched_at", "page_type", "auction_id")


@query
def health_daily(spark, sf_dir):
    return health.health_daily(fx.raw_pages(spark, sf_dir), PACK)


@query
def health_overall(spark, sf_dir):
    return health.health_overall(fx.raw_pages(spark, sf_dir), PACK)


@query
def view_sql(spark, sf_dir):
    """SQL over the registered views."""
    views.register_views(fx.raw_pages(spark, sf_dir), fx.parsed_records(spark, sf_dir), PACK)
    return spark.sql(
        f"""SELECT c.status, count(*) AS lots, count_if(i.has_final) AS sold, CAST(sum(i.final_price) AS BIGINT) AS final_total,
                   count(DISTINCT i.auction_id) AS auctions
            FROM {PACK.name}_items i JOIN {PACK.name}_auction_coverage c USING (auction_id)
            GROUP BY c.status"""
    )


# Tables: landing, versions, retention.


@query
def jsonl_coerce(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    fx.jsonl_lines(spark, sf_dir).write.text(path)
    rows = jsonl.read_jsonl(spark, path, "fallback", at(NOW))
    return rows.select(
        "fetched_at",
        "spider",
        "url",
        "http_status",
        F.coalesce(F.col("headers")["Content-Type"], F.lit("")).alias("content_type"),
        F.size("headers").alias("headers"),
        F.md5("body").alias("body_md5"),
        "payload",
    )


@query
def jsonl_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    jsonl.append_jsonl(fx.raw_pages(spark, sf_dir), path)
    back = jsonl.read_jsonl(spark, f"{path}/site={PACK.name}", "none", at(NOW))
    return back.select("fetched_at", "spider", "url", "http_status", F.md5("body").alias("body_md5"), "payload")


@query
def raw_landing(spark, sf_dir):
    path = scratch_path(spark, "raw")
    tables.append_raw(fx.raw_pages(spark, sf_dir).drop("page_id"), path)
    rows = tables.read_raw(spark, path)
    return rows.select("fetched_at", "spider", "url", "http_status", "has_marker", "body_bytes", "fetch_month")


@query
def stream_landing(spark, sf_dir):
    source, path = scratch_path(spark, "export"), scratch_path(spark, "raw")
    jsonl.append_jsonl(fx.raw_pages(spark, sf_dir), source)
    streams.start_landing(spark, f"{source}/site={PACK.name}", path, scratch_path(spark, "ck"), "none").awaitTermination()
    rows = tables.read_raw(spark, path)
    return rows.select("fetched_at", "spider", "url", "http_status", "has_marker", "body_bytes", "fetch_month")


@query
def header_first_value(spark, sf_dir):
    """Headers given as lists keep their first value; bodies given as bytes become text."""
    pages = fx.raw_pages(spark, sf_dir)
    several = F.transform_values("headers", lambda k, v: F.array(v, F.lit("second")))
    given = pages.withColumn("headers", several).withColumn("body", F.col("body").cast("binary"))
    rows = landing.coerce_pages(given, "none", at(NOW))
    return rows.select("url", "fetched_at", F.col("headers")["Content-Type"].alias("content_type"), F.md5("body").alias("body_md5"))


@query
def time_normaliser(spark, sf_dir):
    """ISO text in several spellings to UTC; what is no time becomes the given now."""
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey")
    given = (
        F.when(key % 5 == 0, fx.cat(stamp, "T10:20:30Z"))
        .when(key % 5 == 1, fx.cat(stamp, "T10:20:30+05:30"))
        .when(key % 5 == 2, fx.cat(stamp, " 10:20:30.250"))
        .when(key % 5 == 3, fx.cat("on ", stamp))
    )
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", given.alias("given"))
    return rows.select("o_orderkey", tx.utc_time(F.col("given"), at(NOW)).alias("utc"))


@query
def latest_version(spark, sf_dir):
    first = fx.auction_records(spark, sf_dir)
    again = first.withColumn("parsed_at", F.col("parsed_at") + F.expr("INTERVAL 1 HOUR"))
    rows = versions.with_content_key(first.unionAll(again).unionAll(first))
    newest = versions.latest_versions(rows)
    return newest.select("source_month", "url", "record_type", "parsed_at", "source_fetched_at", "fields")


@query
def content_key(spark, sf_dir):
    """The same record with its keys in another order has the same key."""
    rows = fx.auction_records(spark, sf_dir)
    record = F.from_json("fields", "status string, date_iso string, type string, auction_id string")
    shuffled = rows.withColumn("fields", F.to_json(record))
    keyed = versions.with_content_key(rows.unionAll(shuffled))
    return keyed.groupBy("url").agg(F.count("*").alias("rows"), F.count_distinct("dedup_key").alias("contents"))


@query
def canonical_record(spark, sf_dir):
    """Record text with keys sorted and spacing dropped."""
    spaced = F.regexp_replace("fields", '":"', '" : "')
    rows = fx.auction_records(spark, sf_dir)
    return rows.select("url", "parsed_at", canonical_json(spaced).alias("fields"))


@query
def month_partitions(spark, sf_dir):
    rows = versions.with_content_key(fx.item_records(spark, sf_dir).drop("record_type"))
    return rows.groupBy("source_month", "record_type").agg(F.count("*").alias("rows"))


@query
def retention(spark, sf_dir):
    raw = landing.landed(fx.raw_pages(spark, sf_dir).drop("page_id"))
    return versions.unexpired(raw, at(RETENTION_NOW)).select("url", "fetched_at")


# Page quality.


@query
def page_gate(spark, sf_dir):
    gated = quality.with_verdict(fx.raw_pages(spark, sf_dir), PACK)
    return gated.select("page_id", "url", "reason", "retryable")


@query
def disposition(spark, sf_dir):
    pages = fx.raw_pages(spark, sf_dir).withColumn("retry_times", (F.col("page_id") % 7).cast("int"))
    routed = quality.with_disposition(quality.with_verdict(pages, PACK), PACK.retry_times)
    return routed.select("page_id", "disposition")


def squeezed(body: Column, kind: Column) -> Column:
    """Bytes as they are, or compressed one of three ways."""

    @F.arrow_udf("binary")
    def squeeze(bodies: pa.Array, kinds: pa.Array) -> pa.Array:
        pack = {1: gzip.compress, 2: zlib.compress, 3: lambda b: zlib.compress(b)[2:-4], 4: gzip.compress}
        return pa.array([pack.get(k, bytes)(b) for b, k in zip(bodies.to_pylist(), kinds.to_pylist())], pa.binary())

    return squeeze(body, kind)


@query
def routed_landing(spark, sf_dir):
    """Pages as captured, plain or compressed, and robots files, stored under their disposition; the accepted ones are a raw table."""
    path = scratch_path(spark, "routed")
    robots, kind = F.col("page_id") % 19 == 7, F.when(quality.is_page(), F.col("page_id") % 5).otherwise(0).cast("int")
    pages = fx.raw_pages(spark, sf_dir).select(
        "fetched_at",
        "spider",
        F.when(robots, fx.cat(fx.HOME, "/robots.txt")).otherwise(F.col("url")).alias("url"),
        "http_status",
        F.create_map(F.lit("content-encoding"), F.when(kind.isin(2, 3), "deflate").otherwise("identity")).alias("headers"),
        squeezed(F.when(robots, F.substring("body", 1, 100)).otherwise(F.col("body")).cast("binary"), kind).alias("body"),
        "payload",
        (F.col("page_id") % 7).cast("int").alias("retry_times"),
    )
    tables.append_routed(pages, PACK, path)
    groups = tables.read_routed(spark, path).groupBy("disposition", "fetch_month", "has_marker")
    return groups.agg(F.count("*").alias("pages"), F.sum("body_bytes").alias("bytes"))


@query
def bad_sample(spark, sf_dir):
    return quality.bad_sample(quality.with_verdict(fx.raw_pages(spark, sf_dir), PACK))


@query
def quarantine_report(spark, sf_dir):
    return quality.quarantine_report(quality.with_verdict(fx.raw_pages(spark, sf_dir), PACK))


@query
def inflate_bodies(spark, sf_dir):
    """Bodies compressed three ways, some without saying so, come back as they were."""

    kind = (F.col("page_id") % 5).cast("int")
    encoding = F.when(kind == 1, "gzip").when(kind.isin(2, 3), "deflate").otherwise("identity")
    pages = fx.raw_pages(spark, sf_dir)
    sent = pages.select(
        "page_id",
        "http_status",
        squeezed(F.col("body").cast("binary"), kind).alias("body"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("content-encoding"), encoding).alias("headers"),
    )
    plain = quality.inflate_bodies(sent.filter(quality.is_page()))
    return plain.select("page_id", F.md5("body").alias("body_md5"), F.size("headers").alias("headers"))


# Extraction.


def _records(pages: DataFrame, site: str) -> DataFrame:
    return extract.explode_records(pages.select("url", "body"), site).select("url", "record.*")


@query
def page_records(spark, sf_dir):
    return joined_images(_records(fx.raw_pages(spark, sf_dir), PACK.name)).select(
        "url", "type", "auction_id", "lot_number", "title", "start_price", "views", "images"
    )


@query
def parsed_rows(spark, sf_dir):
    """The rows the parse job appends for the raw pages."""
    rows = extract.parse_pages(fx.raw_pages(spark, sf_dir), PACK, at(NOW))
    return rows.select("spider", "url", "source_fetched_at", "parsed_at", "record_type", "source_month", "fields")


@query
def site_routing(spark, sf_dir):
    """Pages of two sites in one table, each read by its own rules."""
    pages = fx.quote_pages(spark, sf_dir).unionByName(fx.book_pages(spark, sf_dir))
    rows = extract.parse_sites(pages, ["quotes", "books"], at(NOW))
    return rows.groupBy("spider", "source_month").agg(F.count("*").alias("records"), F.count_distinct("url").alias("pages"))


@query
def zero_yield(spark, sf_dir):
    return extract.page_yield(fx.raw_pages(spark, sf_dir), PACK)


@query
def quote_records(spark, sf_dir):
    rows = _records(fx.quote_pages(spark, sf_dir), "quotes")
    return rows.withColumn("tags", F.array_join("tags", ",")).drop("source_url")


QUOTE_SQL = """
SELECT url, coalesce({strip_text}, '') AS text, coalesce({strip_author}, '') AS author,
  array_join(transform(filter(nodes, t -> t.tag = '#text' AND exists(nodes, n -> n.idx = t.parent AND n.tag = 'a' AND contains(n.class, ' tag ')
    AND exists(nodes, d -> d.tag = 'div' AND contains(d.class, ' tags ') AND n.idx > d.idx AND n.idx <= d.idx + d.size))), t -> t.text), ',') AS tags
FROM quote_pages, LATERAL explode(quote_blocks(body, url, 'div', 'quote')) AS b(nodes)"""


def _own_text(tag: str, cls: str) -> str:
    """SQL for the stripped first text run directly in an element of a block."""
    inside = f"exists(nodes, n -> n.idx = t.parent AND n.tag = '{tag}' AND contains(n.class, ' {cls} '))"
    return rf"regexp_replace(get(filter(nodes, t -> t.tag = '#text' AND {inside}), 0).text, r'(?U)\A\s+|\s+\z', '')"


@query
def quote_records_sql(spark, sf_dir):
    """`quote_records` written in SQL, over the blocks of its pages."""
    register_page_blocks(spark, "quote_blocks")
    fx.quote_pages(spark, sf_dir).createOrReplaceTempView("quote_pages")
    return spark.sql(QUOTE_SQL.format(strip_text=_own_text("span", "text"), strip_author=_own_text("small", "author")))


@query
def book_records(spark, sf_dir):
    return _records(fx.book_pages(spark, sf_dir), "books").drop("source_url")


@query
def catalog_records(spark, sf_dir):
    return joined_images(_records(fx.catalog_pages(spark, sf_dir), PACK.name))


@query
def lot_records(spark, sf_dir):
    return joined_images(_records(fx.lot_pages(spark, sf_dir), PACK.name)).select(
        "url", "type", "auction_id", "lot_number", "lot_index", "title", "description", "start_price", "final_price",
        "views", "images", "source_url",
    )


@query
def ru_date(spark, sf_dir):
    months = F.array(*map(F.lit, tx.RU_MONTHS))
    key, word = F.col("o_orderkey"), F.get(months, F.month("o_orderdate") - 1)
    given = (
        F.when(key % 4 == 0, fx.cat(fx.text(F.dayofmonth("o_orderdate")), " ", word, " ", fx.text(F.year("o_orderdate")), " года"))
        .when(key % 4 == 1, fx.cat("с ", fx.text(F.dayofmonth("o_orderdate")), " ", F.upper(word), "\n", fx.text(F.year("o_orderdate"))))
        .when(key % 4 == 2, fx.cat(fx.text(F.dayofmonth("o_orderdate")), " брюмера ", fx.text(F.year("o_orderdate"))))
        .otherwise(F.lit("скоро"))
    )
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", tx.ru_date_iso(given).alias("iso"))


@query
def text_clean(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    padded = fx.cat("  ", F.replace("text", F.lit(", "), F.lit(",  \t")), "\r\n")
    return docs.select("doc_id", F.md5(tx.clean_text(padded)).alias("clean_md5"))


@query
def url_ids(spark, sf_dir):
    key, k = F.col("o_orderkey"), fx.text("o_orderkey")
    url = (
        F.when(key % 6 == 0, fx.cat(fx.HOME, "/auction/", k, "/"))
        .when(key % 6 == 1, fx.cat("/auction/", k, "s1/84a/"))
        .when(key % 6 == 2, fx.cat(fx.HOME, "/auction/", k, ".2/", k, "/?x=1"))
        .when(key % 6 == 3, fx.cat(fx.HOME, "/auction/archives/", k, "/"))
        .when(key % 6 == 4, fx.cat(fx.HOME, "/auction/", k))
        .otherwise(F.lit(""))
    )
    group, entry = ux.url_ids(F.col("url"), PACK.urls)
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", url.alias("url"))
    return rows.select("o_orderkey", group.alias("auction_id"), entry.alias("lot_number"))


# Incremental reading.


@query
def watermark_read(spark, sf_dir):
    progress = fx.event_progress(spark, sf_dir)
    named = [incremental.watermark(progress, s).withColumn("spider", F.lit(s)) for s in ("click", "view", "never")]
    return named[0].unionAll(named[1]).unionAll(named[2])


@query
def incremental_batch(spark, sf_dir):
    return incremental.next_batch(fx.event_pages(spark, sf_dir), "click", at(REPLAY_SINCE), BATCH)


@query
def incremental_exact(spark, sf_dir):
    return incremental.next_exact(fx.event_pages(spark, sf_dir), "view", at(REPLAY_SINCE), None, BATCH)


@query
def replay_since(spark, sf_dir):
    return incremental.replay(fx.event_pages(spark, sf_dir), "click", datetime.fromisoformat(REPLAY_SINCE))


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.select("spider", "url", "source_fetched_at", "record_type", "source_month", "fields")


@query
def batch_drain(spark, sf_dir):
    """Land, extract what is new, run again: the second run finds nothing."""
    raw, parsed, progress = (scratch_path(spark, n) for n in ("raw", "parsed", "progress"))
    tables.append_raw(fx.raw_pages(spark, sf_dir).drop("page_id"), raw)
    for _ in range(2):
        incremental.drain(spark, raw, parsed, progress, PACK)
    return _parsed(tables.read_parsed(spark, parsed))


@query
def stream_drain(spark, sf_dir):
    """The same as a stream over the landed files, restarted once on its checkpoint."""
    raw, parsed, checkpoint = (scratch_path(spark, n) for n in ("raw", "parsed", "checkpoint"))
    tables.append_raw(fx.raw_pages(spark, sf_dir).drop("page_id"), raw)
    for _ in range(2):
        streams.start_parse(spark, raw, parsed, checkpoint, PACK).awaitTermination()
    return _parsed(tables.read_parsed(spark, parsed))


# A numeric character reference of so many digits cannot be read; a page that holds it cannot be split.
POISON = "&#" + "9" * 5000 + ";"


@query
def poisoned_drain(spark, sf_dir):
    """Some pages cannot be split, half of all come in a batch and half in a stream: records of the others, and a row for each of these."""
    raw, parsed, progress, errors, checkpoint = (scratch_path(spark, n) for n in ("raw", "parsed", "progress", "errors", "checkpoint"))
    pages = fx.raw_pages(spark, sf_dir)
    poisoned = F.when(F.col("page_id") % 23 == 5, fx.cat(POISON, F.col("body"))).otherwise(F.col("body"))
    bad = pages.withColumn("body", poisoned)
    for half, path in enumerate((raw, f"{raw}-streamed")):
        tables.append_raw(bad.filter(F.col("page_id") % 2 == half).drop("page_id"), path)
    incremental.drain(spark, raw, parsed, progress, PACK, errors_path=errors)
    streams.start_parse(spark, f"{raw}-streamed", parsed, checkpoint, PACK, errors_path=errors).awaitTermination()
    failed = tables.read_errors(spark, errors).select("url", "source_fetched_at", F.regexp_extract("error", "^[A-Za-z]+", 0).alias("error"))
    return tables.read_parsed(spark, parsed).select("url", "source_fetched_at", "fields").unionByName(failed, allowMissingColumns=True)


STEP = 60


@query
def mixed_drain(spark, sf_dir):
    """Batch, streams and batch again into the same raw and parsed paths; everything is read back."""
    raw, parsed, progress, source, land, parse = (scratch_path(spark, n) for n in ("raw", "parsed", "progress", "export", "ck-land", "ck-parse"))
    pages = fx.raw_pages(spark, sf_dir)
    tables.append_raw(pages.filter(F.col("page_id") % 2 == 0).drop("page_id"), raw)
    incremental.drain(spark, raw, parsed, progress, PACK)
    jsonl.append_jsonl(pages.filter(F.col("page_id") % 2 == 1), source)
    streams.start_landing(spark, f"{source}/site={PACK.name}", raw, land, "none").awaitTermination()
    streams.start_parse(spark, raw, parsed, parse, PACK).awaitTermination()
    incremental.drain(spark, raw, parsed, progress, PACK)
    return _parsed(versions.latest_versions(tables.read_parsed(spark, parsed)))


@query
def drain_metrics(spark, sf_dir):
    """What each step of a drain read and wrote, and how far it came."""
    raw, parsed, progress, batches = (scratch_path(spark, n) for n in ("raw", "parsed", "progress", "batches"))
    tables.append_raw(fx.raw_pages(spark, sf_dir).drop("page_id"), raw)
    incremental.drain(spark, raw, parsed, progress, PACK, batch_rows=STEP, batches_path=batches)
    return tables.read_batches(spark, batches).select("batch", "pages", "records", "watermark")


def _refetched(spark, sf_dir) -> DataFrame:
    raw, parsed, progress = (scratch_path(spark, n) for n in ("raw", "parsed", "progress"))
    tables.append_raw(fx.refetched_pages(spark, sf_dir), raw)
    incremental.drain(spark, raw, parsed, progress, PACK)
    return tables.read_parsed(spark, parsed)


@query
def drained_facts(spark, sf_dir):
    """Several fetches of each lot, extracted in one run: the newest fetch says what holds."""
    facts = items.item_facts(_refetched(spark, sf_dir), PACK)
    return facts.select("auction_id", "lot_number", "title", F.col("start_price").cast("bigint"), "last_source_fetched_at")


@query
def drained_status(spark, sf_dir):
    """The same for auctions: once completed, always; else the newest label; the newest date shown."""
    return coverage.auction_rollup(_refetched(spark, sf_dir), PACK).drop("last_parsed_at")


@query
def compacted(spark, sf_dir):
    """Landed twice and once more, later; compaction leaves the newest."""
    path = scratch_path(spark, "parsed")
    first = fx.auction_records(spark, sf_dir).drop("record_type")
    for rows in (first, first.withColumn("parsed_at", F.col("parsed_at") + F.expr("INTERVAL 1 HOUR")), first):
        tables.append_parsed(rows, path)
    tables.compact_parsed(spark, path)
    return tables.read_parsed(spark, path).select("source_month", "url", "parsed_at", "fields")


@query
def expired(spark, sf_dir):
    """Landed pages after retention was run over them."""
    path = scratch_path(spark, "raw")
    tables.append_raw(fx.raw_pages(spark, sf_dir).drop("page_id"), path)
    tables.expire_raw(spark, path, datetime.fromisoformat(RETENTION_NOW))
    return tables.read_raw(spark, path).select("url", "fetched_at")


@query
def expired_stream(spark, sf_dir):
    """Land, stream, expire, stream again: no record is extracted twice, and what is left of the pages is what has not expired."""
    raw, parsed, checkpoint = (scratch_path(spark, n) for n in ("raw", "parsed", "checkpoint"))
    tables.append_raw(fx.raw_pages(spark, sf_dir).drop("page_id"), raw)
    for _ in range(2):
        streams.start_parse(spark, raw, parsed, checkpoint, PACK).awaitTermination()
        tables.expire_raw(spark, raw, datetime.fromisoformat(RETENTION_NOW))
    left = tables.read_raw(spark, raw).select("url", F.col("fetched_at").alias("at"), F.lit("page").alias("kind"))
    records = tables.read_parsed(spark, parsed).select("url", F.col("source_fetched_at").alias("at"), F.lit("record").alias("kind"))
    return left.unionAll(records)


@query
def landed_twice(spark, sf_dir):
    """Batches of a landing that are run again change nothing: daily health of what is there."""
    path = scratch_path(spark, "raw")
    pages = fx.raw_pages(spark, sf_dir)
    for batch in (0, 1, 0, 1, 1):
        mine = pages.filter(F.col("page_id") % 2 == batch).drop("page_id")
        tables.land_batch(mine, path, tables.batch_label("landing", batch))
    return health.health_daily(tables.read_raw(spark, path), PACK)


@query
def item_facts_kept(spark, sf_dir):
    """Item facts of a state that took the records in five steps, one of them twice, the newest first."""
    path = scratch_path(spark, "items")
    # Written once, a folder for each part: else every step makes and hashes all records, where the table is read, for a quarter of them.
    parts, part = scratch_path(spark, "records"), F.pmod(F.xxhash64("fields"), F.lit(4))
    fx.parsed_records(spark, sf_dir).withColumn("part", part).write.partitionBy("part").parquet(parts)
    records = spark.read.parquet(parts)
    for step in (3, 1, 0, 1, 2):
        states.advance_items(records.filter(F.col("part") == step).drop("part"), path, PACK)
    numbers = {n: F.col(n).cast("bigint") for n in ("start_price", "leading_bid", "final_price", "views")}
    return joined_images(states.item_facts_kept(spark, path)).withColumns(numbers)


@query
def health_rollup(spark, sf_dir):
    return health.health(fx.raw_pages(spark, sf_dir), PACK)


@query
def health_stream(spark, sf_dir):
    """Daily health of a stream that gets the newer half of the pages first, is stopped, and goes on a file at a time."""
    raw, path, checkpoint = (scratch_path(spark, n) for n in ("raw", "health", "checkpoint"))
    pages = fx.raw_pages(spark, sf_dir)
    for half in (1, 0):
        tables.append_raw(pages.filter((F.col("page_id") % 100 >= 50).cast("int") == half).drop("page_id").coalesce(2), raw)
        health_streams.start_health(spark, raw, path, checkpoint, PACK, "3650 days", 4).awaitTermination()
    return health_streams.read_health(spark, path).drop("about_auctions_touched")


# Links and work tables.


@query
def site_rules(spark, sf_dir):
    """The links that each site's own rules follow on its pages."""
    found = [
        links.page_links(make(spark, sf_dir), pack.rules, pack.domains)
        for make, pack in ((fx.quote_pages, get_site("quotes")), (fx.book_pages, get_site("books")), (fx.catalog_pages, PACK))
    ]
    return found[0].unionAll(found[1]).unionAll(found[2])


LINK_RULES = LinkRules(allow=("/[A-Za-z.,]+$",), deny=("/th", "/d[a-z]$"), regions=(("nav", ""),))
LINK_DOMAINS = ("example.com", "example.net")


def _page_table(spark, sf_dir) -> DataFrame:
    return fx.dealt(fx.table(spark, sf_dir, "pages").select("url", F.col("html").alias("body")))


@query
def page_links(spark, sf_dir):
    """Every link of the pages, each once per page."""
    return links.page_links(_page_table(spark, sf_dir), LinkRules())


@query
def rule_links(spark, sf_dir):
    return links.page_links(_page_table(spark, sf_dir), LINK_RULES, LINK_DOMAINS)


@query
def next_links(spark, sf_dir):
    return links.next_links(fx.quote_pages(spark, sf_dir))


@query
def domain_filter(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.filter(ux.in_domains(F.col("url"), ("example.org", "m.ththth.example.net")))


@query
def scoped_links(spark, sf_dir):
    groups = fx.table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 10).cast("bigint").alias("g"))
    scope = groups.filter(F.col("g") % 2 == 0).select(fx.text("g").alias("auction_id"))
    return links.scoped_links(fx.crawl_links(spark, sf_dir), PACK, scope)


@query
def skip_existing(spark, sf_dir):
    crawl = fx.crawl_links(spark, sf_dir)
    mine = crawl.filter(ux.in_domains(F.col("dst_url"), PACK.domains))
    return worklists.skip_held(mine, fx.raw_pages(spark, sf_dir), PACK)


@query
def good_entries(spark, sf_dir):
    return worklists.good_entries(fx.raw_pages(spark, sf_dir), PACK)


@query
def heal_set(spark, sf_dir):
    return worklists.heal_set(fx.raw_pages(spark, sf_dir), PACK)


def _url_table(spark: SparkSession, label: str) -> dict[str, str]:
    path = scratch_path(spark, label)
    return {"name": path.rsplit("/", 1)[1].replace("-", "_"), "path": path}


def _url_index(spark, sf_dir) -> str:
    """The pages' URLs in two landings, of which the second comes twice."""
    raw, place = fx.raw_pages(spark, sf_dir), _url_table(spark, "urls")
    for half in (0, 1, 1):
        url_index.index_urls(raw.filter(F.floor(F.col("page_id") / 10) % 2 == half), PACK, buckets=8, **place)
    return place["name"]


@query
def heal_set_indexed(spark, sf_dir):
    return url_index.urls_to_heal(spark, PACK, _url_index(spark, sf_dir))


@query
def skip_existing_indexed(spark, sf_dir):
    crawl, place = fx.crawl_links(spark, sf_dir), _url_table(spark, "targets")
    for early in (True, False):
        some = crawl.filter(ux.in_domains(F.col("dst_url"), PACK.domains) & ((F.col("pos") < 2) == early))
        url_index.index_targets(some, buckets=8, **place)
    return url_index.targets_to_fetch(spark, PACK, place["name"], _url_index(spark, sf_dir))


@query
def heal_set_scoped(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == 1)
    return worklists.heal_set(fx.raw_pages(spark, sf_dir), PACK, orders.select("o_orderkey"))


@query
def heal_outcome(spark, sf_dir):
    raw = fx.raw_pages(spark, sf_dir)
    targets = worklists.heal_set(raw.filter(F.col("page_id") % 4 != 3), PACK)
    return worklists.fetch_outcome(targets, raw, PACK)


@query
def distinct_ids(spark, sf_dir):
    pages = fx.archive_pages(spark, sf_dir)
    return pages.select("page", F.array_join(ux.distinct_ids(F.col("html"), PACK.urls), ",").alias("ids"))


LATEST, ARCHIVE_PAGES = 5000, 100000


@query
def latest_n(spark, sf_dir):
    return worklists.latest_ids(fx.archive_pages(spark, sf_dir), PACK, LATEST, ARCHIVE_PAGES)


@query
def stored_ids(spark, sf_dir):
    return worklists.stored_ids(fx.parsed_records(spark, sf_dir), PACK)


@query
def stored_ids_any(spark, sf_dir):
    return worklists.stored_ids(fx.parsed_records(spark, sf_dir), PACK, completed_only=False)


def _plan(spark, sf_dir, held: bool) -> DataFrame:
    candidates = worklists.latest_ids(fx.archive_pages(spark, sf_dir), PACK, LATEST, ARCHIVE_PAGES)
    return worklists.work_plan(candidates, worklists.stored_ids(fx.auction_records(spark, sf_dir), PACK), held)


@query
def work_plan(spark, sf_dir):
    return _plan(spark, sf_dir, False)


@query
def work_plan_skipped(spark, sf_dir):
    return _plan(spark, sf_dir, True)


@query
def seeds(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "orders").select(fx.text("o_orderkey").alias("auction_id"))
    return worklists.seeds(ids, PACK)


def _known(spark, sf_dir) -> DataFrame:
    site = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    pages = fx.table(spark, sf_dir, "pages")
    spelled = (fx.cat(site, "/the"), fx.cat(F.upper(site), "/la"), fx.cat(site, "/of#part"))
    return reduce(DataFrame.unionAll, [pages.select("url"), *(pages.select(u) for u in spelled)])


FRONTIER_RULES = LinkRules(allow=("/[a-z]+$",))


@query
def frontier_step(spark, sf_dir):
    pack = replace(PACK, rules=FRONTIER_RULES, domains=("example.com", "example.net", "example.org"))
    return worklists.frontier_step(_page_table(spark, sf_dir), pack, _known(spark, sf_dir))


@query
def request_dedup(spark, sf_dir):
    url = F.col("url")
    bare = F.substring_index(url, "#", 1)
    path, args = F.substring_index(bare, "?", 1), F.split(F.substring_index(bare, "?", -1), "&")
    turned = F.when(bare.contains("?"), fx.cat(path, "?", F.array_join(F.reverse(args), "&"))).otherwise(bare)
    pages = fx.table(spark, sf_dir, "pages")
    asked = pages.select("url").unionAll(pages.select(fx.cat(turned, "#again").alias("url")))
    return links.unique_requests(asked).select("canonical_url", "requests")


@query
def request_dedup_stream(spark, sf_dir):
    """Requests asked for twice, in other spellings, over three batches: each passes once."""
    asked, path, checkpoint = (scratch_path(spark, n) for n in ("asked", "requests", "checkpoint"))
    pages = fx.table(spark, sf_dir, "pages").select("url", fx.after_start((F.col("page_id") % 1000).cast("int")).alias("requested_at"))
    for spelled in (F.col("url"), fx.cat(F.col("url"), "#again"), F.col("url")):
        pages.select(spelled.alias("url"), "requested_at").coalesce(1).write.mode("append").parquet(asked)
    stream = spark.readStream.schema("url string, requested_at timestamp").option("maxFilesPerTrigger", 1).parquet(asked)
    requests.start_requests(stream, path, checkpoint, within="30 days").awaitTermination()
    return spark.read.parquet(path).select("canonical_url")


GRAPH_RULES = LinkRules(allow=("/n/[0-9]+",))


@query
def crawl(spark, sf_dir):
    """All that is reached from the graph's first page, with the fewest links to it."""
    pack = replace(PACK, rules=GRAPH_RULES, domains=("graph.example.com",))
    seeds = spark.createDataFrame([(f"{fx.GRAPH}1",), (f"{fx.GRAPH}1#top",)], "url string")
    return worklists.crawl(fx.graph_pages(spark, sf_dir), pack, seeds).select("canonical_url", F.col("depth").cast("bigint").alias("depth"))

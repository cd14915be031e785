"""Times the headline queries and prints one JSON line.

Raw and parsed tables are landed once from the fixtures (timed as `land_*`), then the
views and work lists run over those tables as a user's would, and extraction over
landed markup pages. `land_drain` and `land_stream_drain` extract the landed lot pages, and
the `_lots` rows run over them as a raw table. Each time is the median of BENCH_RUNS runs into a sink that
takes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators import extract, incremental, links, versions, worklists
from leafmill.plans import coverage, health, items
from leafmill.session import build_session
from leafmill.sites.base import LinkRules
from leafmill.sources import tables
from leafmill.streaming import drain as streams
from workload import fixtures as fx
from workload.fixtures import PACK
from workload.queries import ARCHIVE_PAGES, LATEST

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def sink(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = tempfile.mkdtemp(prefix="bench-")
    spent: dict[str, float] = {}

    def land(name: str, write: Callable[[str], None]) -> str:
        path = f"{base}/{name}"
        spent[f"land_{name}"] = timed(lambda: write(path))
        return path

    raw_path = land("raw", lambda p: tables.append_raw(fx.raw_pages(spark, SF_DIR).drop("page_id"), p))
    parsed_path = land("parsed", lambda p: tables.append_parsed(fx.parsed_records(spark, SF_DIR).drop("record_type"), p))
    catalog_path = land("catalog", lambda p: fx.catalog_pages(spark, SF_DIR).write.parquet(p))
    lot_path = land("lots", lambda p: fx.lot_pages(spark, SF_DIR).write.parquet(p))
    captured = spark.read.parquet(lot_path).select(
        "fetched_at",
        "spider",
        "url",
        F.when(F.crc32(F.col("url").cast("binary")) % 11 == 0, 404).otherwise(200).alias("http_status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html")).alias("headers"),
        "body",
        F.lit("{}").alias("payload"),
    )
    many_path = land("raw_lots", lambda p: tables.append_raw(captured, p))
    land("routed", lambda p: tables.append_routed(captured.withColumn("body", F.col("body").cast("binary")), PACK, p))
    land("drain", lambda p: incremental.drain(spark, many_path, p, f"{p}-progress", PACK))
    land("stream_drain", lambda p: streams.start_parse(spark, many_path, p, f"{p}-checkpoint", PACK).awaitTermination())

    raw, parsed = tables.read_raw(spark, raw_path), tables.read_parsed(spark, parsed_path)
    many = tables.read_raw(spark, many_path)
    catalog, lots = spark.read.parquet(catalog_path), spark.read.parquet(lot_path)
    pages = fx.dealt(spark.read.parquet(f"{SF_DIR}/pages.parquet").select("url", F.col("html").alias("body")))
    crawl = fx.crawl_links(spark, SF_DIR)
    queries: dict[str, Callable[[], DataFrame]] = {
        "item_facts": lambda: items.item_facts(parsed, PACK),
        "overview": lambda: coverage.data_overview(parsed, PACK),
        "auction_coverage": lambda: coverage.auction_coverage(raw, parsed, PACK),
        "health_daily": lambda: health.health_daily(raw, PACK),
        "health_overall": lambda: health.health_overall(raw, PACK),
        "latest_version": lambda: versions.latest_versions(parsed),
        "stored_ids": lambda: worklists.stored_ids(parsed, PACK),
        "skip_existing": lambda: worklists.skip_held(crawl, raw, PACK),
        "heal_set": lambda: worklists.heal_set(raw, PACK),
        "heal_set_reading_bodies": lambda: worklists.heal_set(raw.drop("has_marker"), PACK),
        "health_daily_lots": lambda: health.health_daily(many, PACK),
        "auction_coverage_lots": lambda: coverage.auction_coverage(many, parsed, PACK),
        "heal_set_lots": lambda: worklists.heal_set(many, PACK),
        "skip_existing_lots": lambda: worklists.skip_held(many.select(F.col("url").alias("dst_url")), many, PACK),
        "latest_n": lambda: worklists.latest_ids(fx.archive_pages(spark, SF_DIR), PACK, LATEST, ARCHIVE_PAGES),
        "page_links": lambda: links.page_links(pages, LinkRules()),
        "parse_catalog_pages": lambda: extract.parse_pages(catalog, PACK),
        "parse_lot_pages": lambda: extract.parse_pages(lots, PACK),
    }
    for name, make in queries.items():
        runs = []
        for _ in range(RUNS):
            rows = make()  # plan building is not execution; it is timed by no run
            runs.append(timed(lambda: sink(rows)))
        spent[name] = statistics.median(runs)
        print(name, [round(r, 2) for r in runs], file=sys.stderr)
    rates = {
        "catalog_pages_per_sec": catalog.count() / spent["parse_catalog_pages"],
        "lot_pages_per_sec": lots.count() / spent["parse_lot_pages"],
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in spent.items()},
                "rates": {n: round(r, 1) for n, r in rates.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

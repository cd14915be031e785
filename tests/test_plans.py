from contextlib import contextmanager

from pyspark.sql import functions as F

from helpers import raw_rows, times
from leafmill.operators import extract, links
from leafmill.plans import coverage, health, items, views
from leafmill.schemas import PARSED_TABLE
from leafmill.sites.auctions import PACK
from leafmill.sources import tables
from workload import fixtures as fx

HOME = PACK.urls.home


def parsed(spark, records, **columns):
    """Envelope rows from (parsed time, record) pairs."""
    import json

    rows = [(t, json.dumps(r, ensure_ascii=False)) for t, r in records]
    frame = spark.createDataFrame(rows, "t string, fields string")
    return frame.select(
        F.lit(PACK.name).alias("spider"),
        F.lit("u").alias("url"),
        F.col("t").cast("timestamp").alias("source_fetched_at"),
        F.col("t").cast("timestamp").alias("parsed_at"),
        "fields",
    )


def item(auction, lot, **fields):
    return {"type": "item", "auction_id": auction, "lot_number": lot, **fields}


def auction(auction_id, **fields):
    return {"type": "auction", "auction_id": auction_id, **fields}


RECORDS = [
    ("2024-01-01", item("752", "1", title="Old", start_price="1 000 ₽", final_price="2 500", reserve_not_met=True, images=["a"])),
    ("2024-01-02", item("752", "1", title="New", start_price="", description="", images=[], views="7 просмотров")),
    ("2024-01-03", item("752", "1", title="", leading_bid="нет")),
    ("2024-01-01", item("709s1", "84a", start_price="0", final_price="5")),
    ("2024-01-01", item("none", None, title="x")),
    ("2024-01-01", auction("752", date_iso="2024-06-11", status="completed")),
    ("2024-01-02", auction("752", date_iso="", status="unknown")),
    ("2024-01-01", auction("709s1", date_iso="not a date", status="Завтра")),
    ("2024-01-05", auction("709s1", date_iso="", status="Через 3 дня")),
    ("2024-01-09", {"type": "other", "auction_id": "1"}),
]


def test_item_facts_take_the_newest_filled_value_of_each_field(spark):
    rows = {r.auction_id: r.asDict() for r in times(items.item_facts(parsed(spark, RECORDS), PACK), "last_parsed_at", "last_source_fetched_at").collect()}
    assert rows["752"] == {
        "auction_id": "752", "lot_number": "1", "lot_index": "", "title": "New", "description": "", "start_price": 1000,
        "leading_bid": None, "final_price": 2500, "reserve_not_met": True, "views": 7, "images": ["a"], "source_url": "",
        "auction_date": None, "last_parsed_at": "2024-01-03 00:00:00", "last_source_fetched_at": "2024-01-03 00:00:00",
        "auction_id_num": 752, "has_final": True, "final_to_start_ratio": 2.5,
    }
    assert rows["709s1"]["auction_id_num"] == 709 and rows["709s1"]["final_to_start_ratio"] is None
    assert rows["709s1"]["images"] == [] and rows["709s1"]["reserve_not_met"] is False
    assert rows["none"]["lot_number"] == "" and rows["none"]["auction_id_num"] is None and rows["none"]["has_final"] is False
    assert len(rows["752"]) == 18 and len(rows) == 3


def test_equal_times_take_the_larger_value(spark):
    rows = parsed(spark, [("2024-01-01", item("1", "1", title=t)) for t in ("b", "c", "a")])
    assert items.item_facts(rows, PACK).first().title == "c"


def test_rollup_status_is_sticky_and_dates_skip_blanks(spark):
    rows = {r.auction_id: r for r in times(coverage.auction_rollup(parsed(spark, RECORDS), PACK), "last_parsed_at").collect()}
    assert set(rows) == {"752", "709s1"}
    assert (rows["752"].status, rows["752"].date_iso, rows["752"].lots_parsed) == ("completed", "2024-06-11", 1)
    assert (rows["709s1"].status, rows["709s1"].last_parsed_at) == ("Через 3 дня", "2024-01-05 00:00:00")


def test_overview(spark):
    records = [("2024-01-01", auction(str(i), status="completed" if i < 2 else "unknown")) for i in range(4)]
    records += [("2024-01-01", item(str(i % 3), str(i // 3))) for i in range(9)]
    row = coverage.data_overview(times(parsed(spark, records + RECORDS[-1:]), "source_fetched_at"), PACK).first().asDict()
    row["last_parsed_at"] = str(row["last_parsed_at"])[:10]
    assert row == {
        "total_auctions": 4, "completed_auctions": 2, "upcoming_auctions": 2, "total_lots": 9, "avg_lots_per_auction": 2.2,
        "max_lots_per_auction": 3, "auctions_with_lots": 3, "auctions_without_lots": 1, "estimated_total_lots": 9,
        "last_parsed_at": "2024-01-09",
    }


def test_overview_of_nothing(spark):
    row = coverage.data_overview(parsed(spark, RECORDS).limit(0), PACK).first()
    assert (row.total_auctions, row.total_lots, row.avg_lots_per_auction, row.last_parsed_at) == (0, 0, None, None)


RAW = [
    ("2024-01-01 10:00:00", PACK.name, f"{HOME}/auction/752/", 200, ""),
    ("2024-01-01 11:00:00", PACK.name, f"{HOME}/auction/752/1/", 404, ""),
    ("2024-01-02 10:00:00", PACK.name, f"{HOME}/auction/archives/", 200, ""),
    ("2024-01-02 11:00:00", PACK.name, f"{HOME}/auction/709s1/?page=2", 200, ""),
    ("2024-01-02 12:00:00", PACK.name, f"{HOME}/auction/709s1/2/", 503, ""),
    ("2024-01-02 12:00:00", "books", f"{HOME}/auction/709s1/2/", 503, ""),
]


def test_coverage(spark):
    rows = times(coverage.auction_coverage(raw_rows(spark, RAW), parsed(spark, RECORDS), PACK), "last_fetched_at").collect()
    assert [(r.auction_id, str(r.auction_date), r.pages_fetched, r.http_errors, r.last_fetched_at) for r in rows] == [
        ("752", "2024-06-11", 2, 1, "2024-01-01 11:00:00"),
        ("709s1", "None", 2, 1, "2024-01-02 12:00:00"),
    ]


def test_truncation_needs_a_full_page_and_no_second_fetch(spark):
    records = [("2024-01-01", auction(a)) for a in ("752", "752x", "709s1", "1")]
    for a, n in (("752", 36), ("709s1", 36), ("1", 35)):
        records += [("2024-01-01", item(a, str(i))) for i in range(n)]
    rows = coverage.auction_coverage(raw_rows(spark, RAW[:1] + RAW[3:5]), parsed(spark, records), PACK).collect()
    assert {r.auction_id: r.likely_truncated for r in rows} == {"752": True, "709s1": False, "1": False, "752x": False}
    assert next(r for r in rows if r.auction_id == "1").last_fetched_at is None


def test_health(spark):
    days = [r.asDict() for r in health.health_daily(raw_rows(spark, RAW), PACK).collect()]
    assert [tuple(str(v) for v in d.values()) for d in days] == [
        ("2024-01-01", "2", "1", "1", "0.5", "1", "1", "0", "1"),
        ("2024-01-02", "3", "2", "1", "0.3333", "1", "1", "1", "1"),
    ]
    whole = times(health.health_overall(raw_rows(spark, RAW), PACK), "first_fetched_at", "last_fetched_at").first()
    assert tuple(whole) == (5, 3, 2, 0.4, 2, 2, 1, "2024-01-01 10:00:00", "2024-01-02 12:00:00")
    assert health.health_overall(raw_rows(spark, RAW[-1:]), PACK).first().error_rate is None


def test_views_by_name(spark):
    names = views.register_views(raw_rows(spark, RAW), parsed(spark, RECORDS), PACK)
    assert names == [f"{PACK.name}_{n}" for n in ("items", "data_overview", "auction_coverage", "crawl_health_daily", "crawl_health_overall")]
    assert spark.sql(f"SELECT total_auctions FROM {PACK.name}_data_overview").first()[0] == 2
    assert spark.sql(f"SELECT sum(pages_fetched) FROM {PACK.name}_crawl_health_daily").first()[0] == 5
    views.register_views(raw_rows(spark, RAW), parsed(spark, RECORDS[:1]), PACK)
    assert spark.table(names[0]).count() == 1


def test_pages_to_views(spark, tmp_path):
    """Capture to report: land, extract, query."""
    raw_path, parsed_path = str(tmp_path / "raw"), str(tmp_path / "parsed")
    lot = '<b data-lf-microdata="lot-name">Книга</b><b data-lf-microdata="lot-start-price">1 000</b><b class="tm-product-price-final">1 500</b>'
    catalogue = '<div class="uk-display-inline-block"><small>№ 5</small><small>1 мая 2024</small></div><p>Аукцион завершён'
    pages = [
        ("2024-05-02 00:00:00", PACK.name, f"{HOME}/auction/5/", 200, catalogue),
        ("2024-05-02 00:01:00", PACK.name, f"{HOME}/auction/5/1/", 200, lot),
    ]
    tables.append_raw(raw_rows(spark, pages), raw_path)
    raw = tables.read_raw(spark, raw_path)
    tables.append_parsed(extract.parse_pages(raw, PACK), parsed_path)
    views.register_views(raw, tables.read_parsed(spark, parsed_path), PACK)
    row = spark.sql(
        f"""SELECT title, start_price, final_to_start_ratio, auction_date, status, pages_fetched
            FROM {PACK.name}_items JOIN {PACK.name}_auction_coverage USING (auction_id, auction_date)"""
    ).first()
    assert (row.title, row.start_price, row.final_to_start_ratio, str(row.auction_date), row.status, row.pages_fetched) == (
        "Книга", 1000, 1.5, "2024-05-01", "completed", 2,
    )


# Plans.


def written(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "parsed")
    tables.append_raw(raw_rows(spark, RAW), raw)
    tables.append_parsed(parsed(spark, RECORDS), out)
    return tables.read_raw(spark, raw), tables.read_parsed(spark, out)


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@contextmanager
def skew_settings(spark):
    """Thresholds small enough for a test's hot key, and no broadcast to hide it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    raw, out = written(spark, tmp_path)
    facts = plan(items.item_facts(out, PACK))
    assert "EqualTo(record_type,item)" in facts and "EqualTo(record_type,auction)" in facts
    for rows in (health.health_daily(raw, PACK), health.health_overall(raw, PACK), coverage.fetch_rollup(raw, PACK)):
        assert "EqualTo(spider" in plan(rows) and "body:string" not in plan(rows)


def test_rollup_is_one_scan_and_no_row_is_multiplied(spark, tmp_path):
    _, out = written(spark, tmp_path)
    text = plan(coverage.data_overview(out, PACK))
    assert text.count("FileScan") == 1 and "Expand" not in text and "Join" not in text


def test_joins_have_keys(spark, tmp_path):
    raw, out = written(spark, tmp_path)
    for rows in (items.item_facts(out, PACK), coverage.auction_coverage(raw, out, PACK)):
        assert "Cartesian" not in plan(rows) and "NestedLoop" not in plan(rows)


def test_a_hot_auction_is_split_at_run_time(spark, tmp_path):
    """One auction with nearly all lots: the join that adds its date must not be left to one task."""
    lots = spark.range(60000).select(
        F.lit(PACK.name).alias("spider"), F.lit("u").alias("url"), F.lit("2024-01-01").cast("timestamp").alias("source_fetched_at"),
        F.lit("2024-01-01").cast("timestamp").alias("parsed_at"),
        F.to_json(F.struct(
            F.lit("item").alias("type"),
            F.when(F.col("id") % 20 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("auction_id"),
            F.col("id").cast("string").alias("lot_number"),
            F.sha2(F.col("id").cast("string"), 512).alias("description"),
        )).alias("fields"),
        F.lit("item").alias("record_type"),
    )
    dates = lots.limit(0).unionByName(parsed(spark, [("2024-01-01", auction("hot", date_iso="2024-01-01"))]).withColumn("record_type", F.lit("auction")))
    with skew_settings(spark):
        facts = items.item_facts(lots.unionByName(dates), PACK)
        assert facts.filter(F.col("auction_date").isNotNull()).count() == 57000
        facts.collect()
        assert "skew=true" in plan(facts)


def test_links_of_a_hot_group_are_split_at_run_time(spark):
    crawl = spark.range(60000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("src_url"),
        F.when(F.col("id") % 20 > 0, F.lit(f"{HOME}/auction/1/")).otherwise(F.concat(F.lit(f"{HOME}/auction/"), "id", F.lit("/"))).alias("dst_url"),
    )
    ids = spark.range(5000).select(F.col("id").cast("string"))
    with skew_settings(spark):
        kept = links.scoped_links(crawl, PACK, ids)
        assert len(kept.collect()) == 57000 + 250
        assert "skew=true" in plan(kept)


def test_envelope_columns_cover_the_parsed_table(spark, tmp_path):
    _, out = written(spark, tmp_path)
    assert out.schema.names == PARSED_TABLE.names


def test_tables_are_dealt_into_more_partitions_as_they_grow(spark, monkeypatch):
    """A task that makes records of a table sorts them by lot, so its rows must not grow with the table."""
    monkeypatch.setattr(fx, "DEALT_ROWS", 100, raising=False)
    rows = spark.range(2450)
    parts = fx.dealt(rows).rdd.glom().map(len).collect()
    assert len(parts) == 25 and max(parts) <= 130 and sum(parts) == 2450
    assert len(fx.dealt(spark.range(50)).rdd.glom().collect()) == spark.sparkContext.defaultParallelism

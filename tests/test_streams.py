"""Retention under streams, batches that run twice, observed counts, kept states, streamed reports and the crawl to its end."""

import pytest
from pyspark.sql import functions as F

from helpers import raw_rows, times, ts
from leafmill.operators import incremental, worklists
from leafmill.plans import health, items
from leafmill.sites.auctions import PACK
from leafmill.sites.quotes import PACK as QUOTES
from leafmill.sources import saved_pages, states, tables
from leafmill.streaming import drain as streams
from leafmill.streaming import health as health_streams
from leafmill.streaming import requests

QUOTE = '<div class="quote"><span class="text">{0}</span><small class="author">a</small></div>'


def pages_of(spark, rows):
    return raw_rows(spark, [(t, "quotes", f"https://quotes.toscrape.com/{u}", 200, QUOTE.format(u)) for t, u in rows])


def test_expiry_changes_nothing_that_a_stream_has_read(spark, tmp_path):
    raw, parsed, checkpoint = (str(tmp_path / n) for n in ("raw", "parsed", "ck"))
    for t, u in (("2024-01-05 00:00:00", "a"), ("2024-01-20 00:00:00", "b"), ("2024-07-01 00:00:00", "c")):
        tables.append_raw(pages_of(spark, [(t, u)]), raw)
        streams.start_parse(spark, raw, parsed, checkpoint, QUOTES).awaitTermination()
    before = tables.read_parsed(spark, parsed).count()
    for _ in range(2):
        tables.expire_raw(spark, raw, ts("2024-07-10 00:00:00"))
        streams.start_parse(spark, raw, parsed, checkpoint, QUOTES).awaitTermination()
        assert tables.read_parsed(spark, parsed).count() == before == 3
        assert sorted(r.url[-1] for r in tables.read_raw(spark, raw).collect()) == ["b", "c"]


def test_expiry_that_dies_and_is_repeated(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    rows = [("2023-11-05 00:00:00", "w"), ("2024-01-05 00:00:00", "x"), ("2024-01-20 00:00:00", "y"), ("2024-07-01 00:00:00", "z")]
    tables.append_raw(pages_of(spark, rows).coalesce(1), raw)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_delete", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            tables.expire_raw(spark, raw, ts("2024-07-10 00:00:00"))
    for _ in range(2):
        assert sorted(r.url[-1] for r in tables.read_raw(spark, raw).collect()) == ["y", "z"]
        tables.expire_raw(spark, raw, ts("2024-07-10 00:00:00"))
    # An earlier time brings nothing back, and a file with living rows stays whole.
    tables.expire_raw(spark, raw, ts("2024-06-01 00:00:00"))
    assert sorted(r.url[-1] for r in tables.read_raw(spark, raw).collect()) == ["y", "z"]
    assert len(list((tmp_path / "raw" / "fetch_month=2024-01-01").glob("*.parquet"))) == 1
    assert not list((tmp_path / "raw" / "fetch_month=2023-11-01").glob("*.parquet"))


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    raw, parsed = str(tmp_path / "raw"), str(tmp_path / "parsed")
    first, second = pages_of(spark, [("2024-01-05 00:00:00", "a"), ("2024-02-05 00:00:00", "b")]), pages_of(spark, [("2024-01-06 00:00:00", "c")])
    for batch, rows in ((0, first), (1, second), (0, first), (1, second)):
        label = tables.batch_label("ck", batch)
        tables.land_batch(rows, raw, label)
        assert incremental.extract_batch(rows.select("spider", "url", "body", "fetched_at"), parsed, QUOTES, label)[:2] == (rows.count(),) * 2
    tables.append_raw(pages_of(spark, [("2024-01-07 00:00:00", "d")]), raw)
    assert sorted(r.url[-1] for r in tables.read_raw(spark, raw).collect()) == list("abcd")
    assert sorted(r.url[-1] for r in tables.read_parsed(spark, parsed).collect()) == list("abc")
    # A run that died while it moved its files: half of them are there, and some are still aside.
    label = tables.batch_label("ck", 0)
    next((tmp_path / "raw" / "fetch_month=2024-02-01").glob(f"{label}-*")).unlink()
    tables.land_batch(first, raw, label)
    assert sorted(r.url[-1] for r in tables.read_raw(spark, raw).collect()) == list("abcd")
    assert not list((tmp_path / "raw" / "_batches").iterdir())


def test_streams_read_four_columns_once(spark, tmp_path, capfd):
    raw, parsed, batches = (str(tmp_path / n) for n in ("raw", "parsed", "batches"))
    tables.append_raw(pages_of(spark, [("2024-01-05 00:00:00", "a"), ("2024-01-06 00:00:00", "b")]), raw)
    query = streams.start_parse(spark, raw, parsed, str(tmp_path / "ck"), QUOTES, batches_path=batches)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2  # twice as many if a batch were read twice
    query.explain()
    plan = capfd.readouterr().out
    assert "ReadSchema: struct<fetched_at:timestamp,spider:string,url:string,body:string>" in plan and "payload" not in plan
    rows = tables.read_batches(spark, batches).collect()
    assert [(r.pages, r.records) for r in rows] == [(2, 2)] and times(tables.read_batches(spark, batches), "watermark").first().watermark == "2024-01-06 00:00:00"


def test_pages_without_records_are_counted(spark, tmp_path):
    empty = raw_rows(spark, [("2024-01-05 00:00:00", "quotes", "https://quotes.toscrape.com/a", 200, "<p>no</p>")])
    got = incremental.extract_batch(empty.select("spider", "url", "body", "fetched_at"), str(tmp_path / "parsed"), QUOTES)
    assert got == (1, 0, "2024-01-05 00:00:00")
    assert incremental.extract_batch(empty.filter("false").select("spider", "url", "body", "fetched_at"), str(tmp_path / "none"), QUOTES) == (0, 0, None)


def test_batches_and_progress_are_folded(spark, tmp_path):
    batches, progress = str(tmp_path / "batches"), str(tmp_path / "progress")
    for pages in (1, 2):
        tables.append_batch(spark, batches, "s", "run", 0, pages, pages, None)
    assert [r.pages for r in tables.read_batches(spark, batches).collect()] == [2]
    for spider, mark in (("s", "2024-01-01"), ("t", "2024-01-02"), ("s", "2024-01-03")):
        tables.append_progress(spark, progress, spider, f"{mark} 00:00:00")
    for _ in range(2):
        tables.compact_progress(spark, progress)
        assert {(r.spider, str(r.watermark)[:10]) for r in tables.read_progress(spark, progress).collect()} == {("s", "2024-01-03"), ("t", "2024-01-02")}
    assert incremental.watermark(tables.read_progress(spark, progress), "s").select(F.col("watermark").cast("string")).first()[0] == "2024-01-03 00:00:00"


def record(spark, rows):
    """Parsed envelopes from (parsed at, fields)."""
    frame = spark.createDataFrame([(PACK.name, "u", t, t, f) for t, f in rows], "spider string, url string, a string, b string, fields string")
    stamped = frame.select("spider", "url", F.col("a").cast("timestamp").alias("source_fetched_at"), F.col("b").cast("timestamp").alias("parsed_at"), "fields")
    return stamped


def test_kept_facts_are_those_of_all_records(spark, tmp_path):
    steps = [
        record(spark, [("2024-01-02", '{"type":"item","auction_id":"1","lot_number":"1","title":"new","start_price":"5"}')]),
        record(spark, [("2024-01-01", '{"type":"item","auction_id":"1","lot_number":"1","title":"old","final_price":"10","images":["i"]}')]),
        record(spark, [("2024-01-03", '{"type":"item","auction_id":"1","lot_number":"1","title":""}'), ("2024-01-03", '{"type":"auction","auction_id":"1","date_iso":"2024-05-06"}')]),
        record(spark, [("2024-01-04", '{"type":"item","auction_id":"2","lot_number":"9"}'), ("2024-01-04", '{"type":"auction","auction_id":"1","date_iso":""}')]),
    ]
    path, seen = str(tmp_path / "state"), None
    with pytest.raises(ValueError):
        states.item_facts_kept(spark, path)
    for step in [*steps, steps[1]]:
        seen = step if seen is None else seen.unionAll(step)
        states.advance_items(step, path, PACK)
        kept, whole = states.item_facts_kept(spark, path), items.item_facts(seen, PACK)
        assert kept.columns == whole.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, whole.collect()))
    assert len(list((tmp_path / "state").glob("done-*"))) <= states.KEPT
    # A version that was not finished does not count.
    (tmp_path / "state" / "lots-000000099").mkdir()
    assert states.item_facts_kept(spark, path).count() == 2


def test_states_merge_by_a_join_that_keeps_the_newer_of_each_field(spark):
    kind = "k string, l string, a struct<t:int,v:string>, n int"
    state = spark.createDataFrame([("1", "1", (1, "x"), 5), ("1", "2", None, None), ("2", "1", (4, "y"), 1), ("3", "1", (2, "b"), None)], kind)
    other = spark.createDataFrame([("1", "1", (2, "a"), 4), ("1", "2", (1, "z"), None), ("3", "1", (2, "c"), 7), ("4", "1", None, 2)], kind)
    both = items.merged(state, other, "k", "l")
    assert both.columns == state.columns
    assert sorted(map(tuple, both.collect())) == [
        ("1", "1", (2, "a"), 5), ("1", "2", (1, "z"), None), ("2", "1", (4, "y"), 1), ("3", "1", (2, "c"), 7), ("4", "1", None, 2)
    ]
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" in plan and "Aggregate" not in plan and "Union" not in plan


def test_each_step_of_the_kept_facts_reads_its_own_records(spark, monkeypatch):
    from workload import queries

    rows = record(spark, [("2024-01-02", f'{{"type":"item","auction_id":"1","lot_number":"{n}","title":"t{n}"}}') for n in range(40)])
    plans, advance = [], states.advance_items

    def noted(parsed, path, pack):
        plans.append(parsed._jdf.queryExecution().executedPlan().toString())
        advance(parsed, path, pack)

    monkeypatch.setattr(queries.fx, "parsed_records", lambda *_: rows)
    monkeypatch.setattr(states, "advance_items", noted)
    kept = queries.QUERIES["item_facts_kept"](spark, "")
    assert sorted((r.lot_number, r.title) for r in kept.collect()) == sorted((str(n), f"t{n}") for n in range(40))
    for step, plan in zip((3, 1, 0, 1, 2), plans, strict=True):
        assert "(part#" in plan.split("PartitionFilters: ")[1] and f" = {step})" in plan.split("PartitionFilters: ")[1]


def auction_pages(spark, rows):
    return raw_rows(spark, [(t, PACK.name, f"{PACK.urls.home}/auction/{a}/", s, "") for t, a, s in rows])


def test_streamed_health_takes_late_pages_until_the_watermark(spark, tmp_path):
    raw, path, checkpoint = (str(tmp_path / n) for n in ("raw", "health", "ck"))

    def run(rows):
        tables.append_raw(auction_pages(spark, rows).coalesce(1), raw)
        health_streams.start_health(spark, raw, path, checkpoint, PACK, "2 days").awaitTermination()
        return {str(r.fetch_date): (r.pages_fetched, r.errors) for r in health_streams.read_health(spark, path).collect()}

    assert run([("2024-01-10 00:00:00", 1, 200)]) == {"2024-01-10": (1, 0)}
    assert run([("2024-01-09 12:00:00", 2, 404), ("2024-01-10 23:59:59", 1, 200)]) == {"2024-01-09": (1, 1), "2024-01-10": (2, 0)}
    assert run([("2024-01-20 00:00:00", 3, 200)])["2024-01-20"] == (1, 0)
    assert run([("2024-01-09 13:00:00", 4, 200), ("2024-01-19 00:00:00", 4, 200)]) == {
        "2024-01-09": (1, 1), "2024-01-10": (2, 0), "2024-01-19": (1, 0), "2024-01-20": (1, 0)
    }


def test_streamed_health_costs_a_batch_its_days_and_not_the_settings(spark, tmp_path):
    raw, path, checkpoint = (str(tmp_path / n) for n in ("raw", "he[a]lth", "ck"))
    settings = "spark.sql.shuffle.partitions"
    before = spark.conf.get(settings)
    for n, month in enumerate(("01", "02")):
        days = [(f"2024-{month}-{d:02d} 00:00:00", d, 200) for d in range(1, 29)]
        tables.append_raw(auction_pages(spark, days).coalesce(1), raw)
        spark.conf.set(settings, "40")
        try:
            # The second run goes on with the parts of the first.
            health_streams.start_health(spark, raw, path, checkpoint, PACK, "60 days").awaitTermination()
            assert spark.conf.get(settings) == "40"
        finally:
            spark.conf.set(settings, before)
        assert len([p for p in (tmp_path / "ck" / "state" / "0").iterdir() if p.name.isdigit()]) == health_streams.STATE_PARTS
        assert len(list((tmp_path / "he[a]lth" / f"fetch_month=2024-{month}-01").glob("*.parquet"))) == 1
    assert sum(len(list(f.glob("*.parquet"))) for f in (tmp_path / "he[a]lth").glob("fetch_month=*")) == 2


def test_a_batch_that_runs_again_leaves_no_month_of_its_first_run(spark, tmp_path):
    path, label = str(tmp_path / "{t}*"), tables.batch_label("ck", 0)
    first = pages_of(spark, [("2024-01-05 00:00:00", "a"), ("2024-02-05 00:00:00", "b")])
    tables.land_batch(pages_of(spark, [("2024-01-07 00:00:00", "d")]), path, tables.batch_label("ck", 1))
    tables.land_batch(first, path, label)
    tables.land_batch(first.filter("url like '%b'"), path, label)
    held = {f.parent.name[12:19]: f.name[:-14] for f in (tmp_path / "{t}*").glob("fetch_month=*/batch-*.parquet")}
    assert held == {"2024-01": tables.batch_label("ck", 1), "2024-02": label}


def test_one_scan_gives_both_views(spark):
    rows = [("2024-01-10 00:00:00", 1, 200), ("2024-01-10 01:00:00", 1, 404), ("2024-01-11 00:00:00", 1, 200), ("2024-01-11 00:00:00", 2, 500)]
    raw = auction_pages(spark, rows)
    both = health.health(raw, PACK)
    daily = health.health_daily(raw, PACK)
    assert sorted(map(repr, both.filter("level = 'day'").select(*daily.columns).collect())) == sorted(map(repr, daily.collect()))
    total = health.health_overall(raw, PACK)
    named = both.filter("level = 'total'").withColumnRenamed("pages_fetched", "total_pages")
    assert named.select(*total.columns).collect() == total.collect() and named.first().distinct_auctions_touched == 2
    assert both._jdf.queryExecution().executedPlan().toString().count("Scan") == raw._jdf.queryExecution().executedPlan().toString().count("Scan")
    empty = health.health(raw.filter("false"), PACK).collect()
    assert [(r.level, r.pages_fetched) for r in empty] in ([], [("total", None)])


def test_requests_pass_once_within_their_time(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run(rows):
        frame = spark.createDataFrame(rows, "url string, t string").select("url", F.col("t").cast("timestamp").alias("requested_at"))
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("url string, requested_at timestamp").parquet(source)
        requests.start_requests(stream, path, checkpoint, within="1 hour").awaitTermination()
        return sorted(r.canonical_url for r in spark.read.parquet(path).collect())

    assert run([("https://a.com/x?b=1&a=2", "2024-01-01 00:00:00"), ("https://A.com/x?a=2&b=1#top", "2024-01-01 00:10:00")]) == ["https://a.com/x?a=2&b=1"]
    assert len(run([("https://a.com/x?a=2&b=1", "2024-01-01 00:20:00"), ("https://a.com/y", "2024-01-01 00:20:00")])) == 2
    run([("https://a.com/z", "2024-01-02 00:00:00")])
    assert len(run([("https://a.com/y", "2024-01-02 00:01:00")])) == 4


def test_a_crawl_ends_where_nothing_is_new(spark):
    from dataclasses import replace

    from leafmill.sites.base import LinkRules

    pack = replace(PACK, rules=LinkRules(allow=("/p/",)), domains=("g.com",))

    def page(name, *targets):
        return f"https://g.com/p/{name}", "".join(f'<a href="{t}">x</a>' for t in targets)

    pages = spark.createDataFrame([page("a", "b", "/p/c", "/q/no", "https://h.com/p/x"), page("b", "d#one", "a"), page("c", "d", "c"), page("d", "e"), page("z", "y")], "url string, body string")
    seeds = spark.createDataFrame([("https://g.com/p/a",), ("https://G.com/p/a#x",), ("https://g.com/p/none",)], "url string")
    got = {r.canonical_url[len("https://g.com/p/") :]: r.depth for r in worklists.crawl(pages, pack, seeds).collect()}
    assert got == {"a": 0, "none": 0, "b": 1, "c": 1, "d": 2, "e": 3}
    assert worklists.crawl(pages, pack, seeds.filter("false")).count() == 0


def test_saved_pages_are_landed_as_they_arrive_and_extracted_as_any_other(spark, tmp_path):
    saved, raw, parsed = (str(tmp_path / n) for n in ("saved", "raw", "parsed"))
    (tmp_path / "saved").mkdir()
    arrivals = ({"a": QUOTE.format("a"), "b": QUOTE.format("ё")}, {"c": QUOTE.format("c"), "bare": "<p>", "empty": ""}, {})
    for arrived, pages, records in zip(arrivals, (2, 4, 4), (2, 3, 3)):
        for name, body in arrived.items():
            (tmp_path / "saved" / f"{name}.html").write_bytes(body.encode())
        (tmp_path / "saved" / "notes.md").write_text("x")
        streams.start_saved_landing(spark, saved, raw, str(tmp_path / "ck1"), QUOTES, "https://quotes.toscrape.com/").awaitTermination()
        streams.start_parse(spark, raw, parsed, str(tmp_path / "ck2"), QUOTES).awaitTermination()
        assert tables.read_raw(spark, raw).count() == pages
        assert tables.read_parsed(spark, parsed).count() == records
    landed = {r.url.rsplit("/", 1)[-1]: r for r in tables.read_raw(spark, raw).collect()}
    # A file without content is no page, in a batch as in a stream.
    assert sorted(landed) == ["a", "b", "bare", "c"] == sorted(r.url.rsplit("/", 1)[-1] for r in saved_pages.read_saved_pages(spark, saved, "quotes", "https://q/").collect())
    assert landed["b"].body == QUOTE.format("ё") and {r.http_status for r in landed.values()} == {200}

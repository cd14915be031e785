import time
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from helpers import raw_rows, times, ts
from leafmill.operators import extract, incremental, versions
from leafmill.plans import items
from leafmill.sites.auctions import PACK as AUCTIONS
from leafmill.sites.registry import get_site
from leafmill.sources import jsonl, tables
from leafmill.streaming import drain as streams

QUOTES = get_site("quotes")


def listing(*names):
    return "".join(f'<div class="quote"><span class="text">{n}</span></div>' for n in names)


def land(spark, path, rows):
    """(time, body) pages of the quotes site, plus one of another site."""
    own = [(t, "quotes", f"u-{t}-{i}", 200, b) for i, (t, b) in enumerate(rows)]
    tables.append_raw(raw_rows(spark, own + [("2024-01-01 00:00:00", "books", "x", 200, listing("no"))]), path)


def held(spark, path):
    return sorted(r.fields.split('"text":"')[1].split('"')[0] for r in tables.read_parsed(spark, path).collect())


@pytest.fixture
def paths(tmp_path):
    return tuple(str(tmp_path / n) for n in ("raw", "parsed", "progress"))


def test_watermark_is_the_one_written_last(spark, paths):
    path = paths[2]
    assert times(incremental.watermark(tables.read_progress(spark, path), "s"), "watermark").first()[0] == incremental.EPOCH
    for mark in ("2024-05-01 00:00:00", "2024-03-01 00:00:00.5"):
        tables.append_progress(spark, path, "s", mark)
    tables.append_progress(spark, path, "other", "2025-01-01 00:00:00")
    marked = incremental.watermark(tables.read_progress(spark, path), "s")
    assert times(marked, "watermark").first()[0] == "2024-03-01 00:00:00.5"


TIED = [("2024-01-01 00:00:00", "a"), ("2024-01-02 00:00:00", "b"), ("2024-01-02 00:00:00", "c"), ("2024-02-03 00:00:00", "d")]


def test_batches_take_their_ties_along(spark):
    raw = raw_rows(spark, [(t, "s", b, 200, b) for t, b in TIED])
    epoch = F.lit(incremental.EPOCH).cast("timestamp")

    assert sorted(r.url for r in incremental.next_batch(raw, "s", epoch, 2).collect()) == ["a", "b", "c"]
    later = incremental.next_batch(raw, "s", F.lit("2024-01-02").cast("timestamp"), 2)
    assert [r.url for r in later.collect()] == ["d"]


def test_exact_batches_go_on_from_the_last_place(spark):
    pages = [(f"2024-01-0{1 + i // 5} 00:00:00", f"u{i:02d}") for i in range(20)]
    raw = raw_rows(spark, [(t, "s", u, 200, u) for t, u in pages])
    after, url, got = F.lit(incremental.EPOCH).cast("timestamp"), None, []
    while batch := times(incremental.next_exact(raw, "s", after, url, 3), "fetched_at").orderBy("fetched_at", "url").collect():
        assert len(batch) <= 3
        got += [(r.fetched_at, r.url) for r in batch]
        after, url = F.lit(got[-1][0]).cast("timestamp"), F.lit(got[-1][1])
    assert got == pages


def test_offsets_are_converted_in_any_machine_zone(spark, paths, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        plus_five = datetime(2024, 1, 2, 5, tzinfo=timezone(timedelta(hours=5)))
        raw = raw_rows(spark, [(t, "quotes", b, 200, b) for t, b in TIED])
        tables.append_raw(raw, paths[0])
        for since in (plus_five, ts("2024-01-02"), datetime(2024, 1, 2, tzinfo=timezone.utc)):
            assert {r.url for r in incremental.replay(raw, "quotes", since).collect()} == {"d"}
            assert {r.url for r in tables.read_raw(spark, paths[0], since).collect()} == {"d"}
        assert incremental.drain(spark, *paths, QUOTES, since=plus_five)["pages"] == 1
    finally:
        monkeypatch.undo()
        time.tzset()


def test_a_step_reads_its_own_months_only(spark, paths):
    land(spark, paths[0], [(f"2024-0{m}-05 00:00:00", "x") for m in range(1, 7)])
    raw = tables.read_raw(spark, paths[0])
    stamp = lambda t: F.lit(t).cast("timestamp")
    plan = incremental.raw_after(raw, "quotes", stamp("2024-02-01"), stamp("2024-03-05"))._jdf.queryExecution().executedPlan().toString()
    months = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "fetch_month" in months and ">= 2024-02-01" in months and "<= 2024-03-01" in months


def test_newest_fetch_wins_inside_one_drain(spark, paths):
    pack = AUCTIONS
    page = '<h5 data-lf-microdata="lot-name">{}</h5><span data-lf-microdata="lot-start-price">{}</span>'
    rows = [("2024-03-01 00:00:00", "A new", 1000), ("2024-01-01 00:00:00", "Z old", 900), ("2024-02-01 00:00:00", "M mid", 950)]
    own = [(t, pack.name, f"{pack.urls.home}/auction/7/1/", 200, page.format(*v)) for t, *v in rows]
    tables.append_raw(raw_rows(spark, own), paths[0])
    assert incremental.drain(spark, *paths, pack) == {"pages": 3, "records": 3}
    fact = items.item_facts(tables.read_parsed(spark, paths[1]), pack).first()
    assert (fact.title, fact.start_price) == ("A new", 1000)


def test_replay_is_strictly_after_the_given_time(spark):
    raw = raw_rows(spark, [(t, "s", b, 200, b) for t, b in TIED])
    assert {r.url for r in incremental.replay(raw, "s", ts("2024-01-02")).collect()} == {"d"}
    assert incremental.replay(raw, "s").count() == 4


@pytest.mark.parametrize("batch_rows", [None, 1, 2, 100])
def test_drain_handles_each_page_once(spark, paths, batch_rows):
    land(spark, paths[0], [(t, listing(b, b + "2")) for t, b in TIED])
    first = incremental.drain(spark, *paths, QUOTES, batch_rows=batch_rows)
    assert first == {"pages": 4, "records": 8}
    assert incremental.drain(spark, *paths, QUOTES, batch_rows=batch_rows) == {"pages": 0, "records": 0}
    land(spark, paths[0], [("2024-03-01 00:00:00", listing("e")), ("2024-03-02 00:00:00", "<p>nothing")])
    assert incremental.drain(spark, *paths, QUOTES, batch_rows=batch_rows) == {"pages": 2, "records": 1}
    assert held(spark, paths[1]) == sorted(["a", "a2", "b", "b2", "c", "c2", "d", "d2", "e"])


def test_reset_and_since_read_again_and_versions_fold(spark, paths):
    land(spark, paths[0], [(t, listing(b)) for t, b in TIED])
    incremental.drain(spark, *paths, QUOTES)
    assert incremental.drain(spark, *paths, QUOTES, reset=True)["pages"] == 4
    assert incremental.drain(spark, *paths, QUOTES, reset=True, since=ts("2024-01-02"))["pages"] == 1
    assert len(held(spark, paths[1])) == 9
    assert versions.latest_versions(tables.read_parsed(spark, paths[1])).count() == 4


def test_failed_extraction_leaves_the_watermark(spark, paths):
    land(spark, paths[0], [(t, listing(b)) for t, b in TIED])
    broken = replace(QUOTES, extract=lambda nodes, url: F.array(F.struct(F.raise_error(F.lit("boom")).cast("string").alias("text"))))
    with pytest.raises(Exception, match="boom"):
        incremental.drain(spark, *paths, broken)
    assert tables.read_progress(spark, paths[2]).count() == 0
    assert incremental.drain(spark, *paths, QUOTES)["pages"] == 4


POISON = "&#" + "9" * 5000 + ";"


def test_a_page_that_cannot_be_split_costs_a_row(spark, paths, tmp_path):
    raw, parsed, progress = paths
    land(spark, raw, [("2024-01-01 00:00:00", listing("a")), ("2024-01-02 00:00:00", listing("half") + POISON), ("2024-01-03 00:00:00", listing("b", "c"))])
    with pytest.raises(Exception, match="ValueError"):
        incremental.drain(spark, raw, parsed, progress, QUOTES)
    errors = str(tmp_path / "errors")
    assert tables.read_errors(spark, errors).count() == 0
    assert incremental.drain(spark, raw, parsed, progress, QUOTES, errors_path=errors) == {"pages": 3, "records": 3}
    assert held(spark, parsed) == ["a", "b", "c"]
    failed = tables.read_errors(spark, errors).collect()
    assert [(r.spider, r.url, r.error.split(":")[0]) for r in failed] == [("quotes", "u-2024-01-02 00:00:00-1", "ValueError")]
    assert len(failed[0].error) <= 500

    streamed = str(tmp_path / "streamed"), str(tmp_path / "stream-errors")
    streams.start_parse(spark, raw, streamed[0], str(tmp_path / "ck"), QUOTES, errors_path=streamed[1]).awaitTermination()
    assert held(spark, streamed[0]) == ["a", "b", "c"]
    assert tables.read_errors(spark, streamed[1]).count() == 1


def test_pages_that_all_fail_move_the_watermark(spark, paths, tmp_path):
    raw, parsed, progress = paths
    land(spark, raw, [("2024-01-01 00:00:00", POISON)])
    errors = str(tmp_path / "errors")
    assert incremental.drain(spark, raw, parsed, progress, QUOTES, errors_path=errors) == {"pages": 1, "records": 0}
    assert incremental.drain(spark, raw, parsed, progress, QUOTES, errors_path=errors) == {"pages": 0, "records": 0}
    assert tables.read_errors(spark, errors).count() == 1


def test_records_and_errors_come_of_one_pass(spark, paths):
    raw, _, _ = paths
    land(spark, raw, [("2024-01-01 00:00:00", listing("a")), ("2024-01-02 00:00:00", ""), ("2024-01-02 00:00:00", POISON)])
    rows = extract.parse_or_error(tables.read_raw(spark, raw), QUOTES)
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r.fields is None, r.error is None) for r in rows.collect()) == [(False, True), (True, False)]


def test_stream_gives_what_the_batch_gives(spark, paths, tmp_path):
    checkpoint, streamed = str(tmp_path / "ck"), str(tmp_path / "streamed")
    for rows in (TIED[:2], TIED[2:]):
        land(spark, paths[0], [(t, listing(b)) for t, b in rows])
        incremental.drain(spark, *paths, QUOTES, reset=True)
        query = streams.start_parse(spark, paths[0], streamed, checkpoint, QUOTES)
        query.awaitTermination()
    assert held(spark, streamed) == ["a", "b", "c", "d"]
    once = versions.latest_versions(tables.read_parsed(spark, paths[1])).drop("parsed_at")
    assert once.exceptAll(tables.read_parsed(spark, streamed).drop("parsed_at")).count() == 0
    again = streams.start_parse(spark, paths[0], streamed, checkpoint, QUOTES)
    again.awaitTermination()
    assert len(held(spark, streamed)) == 4


def test_batch_and_stream_share_their_tables(spark, paths, tmp_path):
    """Batch, stream and batch again into the same raw and parsed paths, and everything can be read."""
    raw, parsed, progress = paths
    source, batches = str(tmp_path / "in"), str(tmp_path / "batches")
    land(spark, raw, [(t, listing(b)) for t, b in TIED[:1]])
    assert incremental.drain(spark, *paths, QUOTES, batches_path=batches) == {"pages": 1, "records": 1}
    jsonl.append_jsonl(raw_rows(spark, [(t, "quotes", f"v-{b}", 200, listing(b)) for t, b in TIED[1:3]]), source)
    streams.start_landing(spark, f"{source}/site=quotes", raw, str(tmp_path / "land"), "none").awaitTermination()
    streams.start_parse(spark, raw, parsed, str(tmp_path / "ck"), QUOTES, batches_path=batches).awaitTermination()
    land(spark, raw, [(t, listing(b)) for t, b in TIED[3:]])
    assert incremental.drain(spark, *paths, QUOTES, batches_path=batches) == {"pages": 3, "records": 3}
    assert tables.read_raw(spark, raw).filter("spider = 'quotes'").count() == 4
    assert sorted(set(held(spark, parsed))) == ["a", "b", "c", "d"]
    assert versions.latest_versions(tables.read_parsed(spark, parsed)).count() == 4
    noted = times(tables.read_batches(spark, batches), "watermark").orderBy("finished_at").collect()
    assert [(r.pages, r.records, r.watermark) for r in noted] == [
        (1, 1, "2024-01-01 00:00:00"), (3, 3, "2024-01-02 00:00:00"), (3, 3, "2024-02-03 00:00:00"),
    ]


def test_landing_stream_takes_new_files_once(spark, tmp_path):
    source, raw, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "ck"))
    for t, b in TIED:
        jsonl.append_jsonl(raw_rows(spark, [(t, "quotes", "u", 200, b)]), source)
        streams.start_landing(spark, f"{source}/site=quotes", raw, checkpoint, "none").awaitTermination()
    got = times(tables.read_raw(spark, raw), "fetched_at").collect()
    assert sorted((r.fetched_at, r.body) for r in got) == [(t, b) for t, b in TIED]


@pytest.mark.parametrize("job_rows", [1, 2, 5, 1 << 20])
def test_steps_of_a_drain_share_a_job(spark, paths, tmp_path, monkeypatch, job_rows):
    """Steps are cut as one after the other would cut them, however many of them a job takes."""
    batches = str(tmp_path / "batches")
    days = [1, 2, 2, 2, 3, 5, 8, 8, 9]
    land(spark, paths[0], [(f"2024-01-{d:02d} 00:00:00", listing(f"{n}") if n % 2 else "<p>nothing") for n, d in enumerate(days)])
    monkeypatch.setattr(incremental, "JOB_ROWS", job_rows)
    assert incremental.drain(spark, *paths, QUOTES, batch_rows=2, batches_path=batches) == {"pages": 9, "records": 4}
    noted = times(tables.read_batches(spark, batches), "watermark").orderBy("batch").collect()
    assert [(r.batch, r.pages, r.records, r.watermark[8:10]) for r in noted] == [(0, 4, 2, "02"), (1, 2, 1, "05"), (2, 2, 1, "08"), (3, 1, 0, "09")]
    assert held(spark, paths[1]) == ["1", "3", "5", "7"]
    assert len(tables._files(spark, paths[2])) == (1 if job_rows > 5 else 3 if job_rows == 5 else 4)
    assert times(incremental.watermark(tables.read_progress(spark, paths[2]), "quotes"), "watermark").first()[0] == "2024-01-09 00:00:00"

import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F

from helpers import raw_rows, times, ts
from leafmill.operators import landing, versions
from leafmill.schemas import PARSED_TABLE, RAW_TABLE
from leafmill.sites.auctions import PACK
from leafmill.sources import jsonl, saved_pages, tables

NOW = F.lit("2030-01-01").cast("timestamp")


def write_lines(path, lines):
    path.mkdir()
    (path / "part.jsonl").write_text("\n".join(lines), encoding="utf-8")
    return str(path)


def test_jsonl_gaps_get_defaults(spark, tmp_path):
    lines = [
        "",
        json.dumps({"fetched_at": "2024-01-02T03:04:05+03:00", "spider": "s", "url": "u", "http_status": 200,
                    "headers": {"A": "1", "B": 2, "C": None}, "body": "тело", "payload": {"k": [1]}}, ensure_ascii=False),
        json.dumps({"spider": "", "http_status": "404", "headers": None, "payload": {}}),
        "  ",
    ]
    path = write_lines(tmp_path / "in", lines)
    rows = times(jsonl.read_jsonl(spark, path, "fallback", NOW), "fetched_at").orderBy("fetched_at").collect()
    assert [tuple(r) for r in rows] == [
        ("2024-01-02 00:04:05", "s", "u", 200, {"A": "1", "B": "2", "C": "None"}, "тело", '{"k":[1]}'),
        ("2030-01-01 00:00:00", "fallback", "", 404, {}, "", "{}"),
    ]


def test_malformed_line_fails(spark, tmp_path):
    path = write_lines(tmp_path / "in", ['{"url": "a"}', '{"url": '])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jsonl.read_jsonl(spark, path, "s", NOW).collect()


def test_export_appends_and_reads_back(spark, tmp_path):
    raw = raw_rows(spark, [("2026-05-31 12:00:00", "quotes", "https://example.com", 200, "<html>ё</html>")])
    for _ in range(2):
        jsonl.append_jsonl(raw, str(tmp_path / "out"))
    lines = [l for f in (tmp_path / "out" / "site=quotes").glob("*.json") for l in f.read_text("utf-8").splitlines()]
    assert len(lines) == 2 and "https://example.com" in lines[0] and "ё" in lines[0]
    assert json.loads(lines[0])["payload"] == {}
    back = jsonl.read_jsonl(spark, str(tmp_path / "out" / "site=quotes"), "x", NOW)
    assert times(back, "fetched_at").collect() == times(raw, "fetched_at").collect() * 2


def test_raw_table_notes_what_later_jobs_need(spark, tmp_path):
    path = str(tmp_path / "raw")
    body = '<b data-lf-microdata="lot-name">ё</b>'
    tables.append_raw(raw_rows(spark, [("2024-01-31 23:59:59", PACK.name, "u", 200, body)]), path)
    tables.append_raw(raw_rows(spark, [("2024-02-01 00:00:00", "quotes", "v", 200, body)]), path)
    got = tables.read_raw(spark, path).orderBy("fetched_at")
    assert got.schema.names == RAW_TABLE.names
    assert [(r.has_marker, r.body_bytes, str(r.fetch_month)) for r in got.collect()] == [
        (True, len(body.encode()), "2024-01-01"),
        (None, len(body.encode()), "2024-02-01"),
    ]


def test_routed_pages_are_stored_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "routed")
    good = "<b data-lf-microdata>" + "x" * 600
    pages = [(f"2024-01-0{i + 1} 00:00:00", PACK.name, f"{PACK.urls.home}/auction/1/{i}/", s, b)
             for i, (s, b) in enumerate([(200, good), (200, "x" * 600), (200, ""), (503, "down"), (200, good)])]
    tables.append_routed(raw_rows(spark, pages), PACK, path)
    got = tables.read_routed(spark, path)
    assert sorted((r.disposition, r.reason is None, r.has_marker) for r in got.collect()) == [
        ("accept", True, True), ("accept", True, True), ("drop", False, False), ("pass", True, False), ("retry", False, False),
    ]
    assert tables.read_raw(spark, f"{path}/disposition=accept").count() == 2


def test_compressed_pages_are_inflated_before_they_are_judged(spark, tmp_path):
    good = b"<b data-lf-microdata>" + "тело".encode() * 200
    sent = [gzip.compress(good), zlib.compress(good), good, b""]
    rows = [(f"{PACK.urls.home}/auction/1/{i}/", bytearray(b)) for i, b in enumerate(sent)] + [(f"{PACK.urls.home}/robots.txt", bytearray(b"x"))]
    pages = spark.createDataFrame(rows, "url string, body binary").select(
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"), F.lit(PACK.name).alias("spider"), "url", F.lit(200).alias("http_status"),
        F.when(F.col("url").endswith("/1/"), F.create_map(F.lit("Content-Encoding"), F.lit("deflate"))).otherwise(F.create_map().cast("map<string,string>")).alias("headers"),
        "body", F.lit("{}").alias("payload"),
    )
    path = str(tmp_path / "routed")
    tables.append_routed(pages, PACK, path)
    got = {r.url.rsplit("/", 2)[-2 if r.url.endswith("/") else -1]: r for r in tables.read_routed(spark, path).collect()}
    assert [got[k].disposition for k in ("0", "1", "2", "3", "robots.txt")] == ["accept", "accept", "accept", "retry", "accept"]
    assert {got[k].body for k in "012"} == {good.decode()} and got["0"].has_marker
    landed = landing.coerce_pages(pages, "none", NOW)
    assert {r.body for r in landed.filter("url like '%/0/' or url like '%/1/'").collect()} == {good.decode()}


def test_export_keeps_payloads_that_are_no_json(spark, tmp_path):
    raw = raw_rows(spark, [("2026-05-31 12:00:00", "quotes", "u", 200, "x")]).withColumn("payload", F.lit("not {json"))
    jsonl.append_jsonl(raw, str(tmp_path / "out"))
    assert jsonl.read_jsonl(spark, str(tmp_path / "out" / "site=quotes"), "x", NOW).first().payload == "not {json"


def test_lower_bound_prunes_months(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(f"2024-0{m}-15 00:00:00", PACK.name, f"u{m}", 200, "") for m in range(1, 7)]
    tables.append_raw(raw_rows(spark, rows), path)
    late = tables.read_raw(spark, path, F.lit("2024-05-15").cast("timestamp"))
    assert [r.url for r in late.collect()] == ["u6"]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "fetch_month" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "fetched_at" in plan.split("PushedFilters:")[1].split("]")[0]


def test_retention_is_exclusive_at_the_edge(spark):
    rows = [(t, "s", t, 200, "") for t in ("2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-03-01 00:00:00")]
    raw = landing.landed(raw_rows(spark, rows))
    kept = versions.unexpired(raw, F.lit("2024-07-01").cast("timestamp"))
    assert {r.url for r in kept.collect()} == {"2024-01-01 00:00:01", "2024-03-01 00:00:00"}


def test_expire_drops_months_and_rewrites_the_edge(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(t, "s", t, 200, "") for t in ("2023-12-31 00:00:00", "2024-01-01 00:00:00", "2024-01-20 00:00:00", "2024-03-01 00:00:00")]
    tables.append_raw(raw_rows(spark, rows), path)
    tables.expire_raw(spark, path, ts("2024-07-10 00:00:00"))
    assert {r.url for r in tables.read_raw(spark, path).collect()} == {"2024-01-20 00:00:00", "2024-03-01 00:00:00"}
    tables.expire_raw(spark, path, ts("2030-01-01 00:00:00"))
    assert tables.read_raw(spark, path).count() == 0
    tables.expire_raw(spark, str(tmp_path / "none"), ts("2030-01-01 00:00:00"))


def test_registered_tables_know_what_was_landed(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.append_raw(raw_rows(spark, [("2024-01-01 00:00:00", "s", "u", 200, "")]), path)
    tables.create_table(spark, "raw_landed", RAW_TABLE, "fetch_month", path)
    assert spark.table("raw_landed").count() == 1
    spark.sql("DROP TABLE raw_landed")


def envelope(spark, rows):
    plain = spark.createDataFrame(rows, "url string, source string, parsed string, fields string")
    return plain.select(
        F.lit(PACK.name).alias("spider"), "url", F.col("source").cast("timestamp").alias("source_fetched_at"),
        F.col("parsed").cast("timestamp").alias("parsed_at"), "fields",
    )


VERSIONED = [
    ("u", "2024-01-05", "2024-01-06", '{"type":"item","a":"1"}'),
    ("u", "2024-01-07", "2024-01-08", '{"a": "1", "type": "item"}'),
    ("u", "2024-01-07", "2024-01-08", '{"a":"2","type":"item"}'),
    ("u", "2024-02-07", "2024-02-08", '{"a":"1","type":"item"}'),
    ("v", "2024-01-05", "2024-01-06", '{"a":"1","type":"item"}'),
]
NEWEST = {
    ("u", "2024-01-01", "2024-01-08 00:00:00", "2024-01-07 00:00:00", '{"a":"1","type":"item"}'),
    ("u", "2024-01-01", "2024-01-08 00:00:00", "2024-01-07 00:00:00", '{"a":"2","type":"item"}'),
    ("u", "2024-02-01", "2024-02-08 00:00:00", "2024-02-07 00:00:00", '{"a":"1","type":"item"}'),
    ("v", "2024-01-01", "2024-01-06 00:00:00", "2024-01-05 00:00:00", '{"a":"1","type":"item"}'),
}


def summary(rows):
    shown = times(rows, "parsed_at", "source_fetched_at").collect()
    return [(r.url, str(r.source_month), r.parsed_at, r.source_fetched_at, r.fields) for r in shown]


def test_latest_versions(spark):
    rows = versions.with_content_key(envelope(spark, VERSIONED))
    got = summary(versions.latest_versions(rows))
    assert len(got) == 4 and set(got) == NEWEST


def test_hot_record_is_folded_before_the_shuffle(spark):
    rows = versions.with_content_key(envelope(spark, VERSIONED[:1]))
    plan = versions.latest_versions(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_compaction_keeps_what_is_landed_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "parsed")
    for _ in range(2):
        tables.append_parsed(envelope(spark, VERSIONED), path)
    folded = tables.latest_versions

    def slow(rows):
        # Another job appends between the listing and the rewrite.
        tables.append_parsed(envelope(spark, [("late", "2024-01-05", "2024-01-06", '{"type":"item"}')]), path)
        return folded(rows)

    monkeypatch.setattr(tables, "latest_versions", slow)
    tables.compact_parsed(spark, path, ["2024-01-01"])
    monkeypatch.undo()
    tables.compact_parsed(spark, path)
    got = summary(tables.read_parsed(spark, path))
    assert len(got) == 5 and NEWEST < set(got) and [g[0] for g in set(got) - NEWEST] == ["late"]


def test_plain_envelopes_can_be_appended(spark, tmp_path):
    path = str(tmp_path / "parsed")
    tables.append_parsed(envelope(spark, VERSIONED), path)
    got = tables.read_parsed(spark, path)
    assert got.schema.names == PARSED_TABLE.names and got.filter("record_type = 'item'").count() == 5


def test_saved_pages(spark, tmp_path):
    (tmp_path / "listing.html").write_bytes("<p>ё".encode())
    (tmp_path / "notes.md").write_text("x")
    page = saved_pages.read_saved_pages(spark, str(tmp_path), "quotes", "https://q/").first()
    assert (page.spider, page.url, page.body) == ("quotes", "https://q/listing", "<p>ё")

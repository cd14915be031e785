import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from leafmill.operators import quality
from leafmill.sites.auctions import PACK
from leafmill.sites.registry import get_site

LOT, CATALOG = f"{PACK.urls.home}/auction/716/90/", f"{PACK.urls.home}/auction/716/"
GOOD = b"<b data-lf-microdata='lot-name'>A book</b>" + b"<!-- pad -->" * 60
STRIPPED = b"<div>other</div>" * 60


def pages(spark, rows):
    """(url, status, body, headers, retry_times)"""
    schema = "url string, http_status int, body binary, headers map<string,string>, retry_times int"
    return spark.createDataFrame(rows, schema).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))


def raw_deflate(body):
    squeeze = zlib.compressobj(wbits=-15)
    return squeeze.compress(body) + squeeze.flush()


@pytest.mark.parametrize(
    "body, encoding, plain",
    [
        (gzip.compress(GOOD), None, True),
        (gzip.compress(GOOD), "GZIP", True),
        (gzip.compress(GOOD), "identity", True),
        (zlib.compress(GOOD), "deflate", True),
        (raw_deflate(GOOD), "deflate", True),
        (GOOD, "gzip", False),
        (GOOD, "deflate", False),
        (b"\x1f\x8bbroken", None, False),
        (GOOD, None, False),
        (b"", "gzip", False),
    ],
)
def test_inflate(spark, body, encoding, plain):
    headers = {"Content-Type": "text/html"} | ({"Content-Encoding": encoding} if encoding else {})
    row = quality.inflate_bodies(pages(spark, [(LOT, 200, body, headers, 0)])).first()
    assert bytes(row.body) == (GOOD if plain else body)
    assert ("Content-Encoding" in row.headers) == (encoding is not None and not plain)


def test_errors_are_not_inflated(spark):
    body = gzip.compress(GOOD)
    assert bytes(quality.inflate_bodies(pages(spark, [(LOT, 503, body, {}, 0)])).first().body) == body


@pytest.mark.parametrize(
    "url, status, body, tried, reason, where",
    [
        (LOT, 200, GOOD, 0, None, "accept"),
        (LOT, 200, b"", 0, "empty/short body (0 bytes)", "retry"),
        (LOT, 200, b"", 5, "empty/short body (0 bytes)", "drop"),
        (LOT, 200, b"x" * 499, 4, "empty/short body (499 bytes)", "retry"),
        (LOT, 200, STRIPPED, 0, "lot page missing lot microdata", "drop"),
        (CATALOG, 200, STRIPPED, 0, None, "accept"),
        (CATALOG, 204, b"", 0, "empty/short body (0 bytes)", "retry"),
        (CATALOG, 503, b"upstream error", 0, None, "pass"),
        (f"{PACK.urls.home}/robots.txt", 200, b"", 0, None, "accept"),
    ],
)
def test_gate_and_routing(spark, url, status, body, tried, reason, where):
    routed = quality.route(pages(spark, [(url, status, body, {}, tried)]), PACK)
    assert {name: rows.count() for name, rows in routed.items()} == {
        name: int(name == where) for name in ("pass", "accept", "retry", "drop")
    }
    assert routed[where].first().reason == reason


def test_gate_reads_text_bodies_and_sites_without_marker(spark):
    page = pages(spark, [(LOT, 200, STRIPPED, {}, 0)]).withColumn("body", F.col("body").cast("string"))
    assert quality.with_verdict(page, PACK).first().reason == quality.NO_MARKER
    assert quality.with_verdict(page, get_site("quotes")).first().reason is None


def test_sample_and_report(spark):
    rows = [(f"{CATALOG}?page={i:03d}", 200, "é".encode() * 200, {"content-type": "text/html"}, 0) for i in range(30)]
    gated = quality.with_verdict(pages(spark, rows + [(LOT, 200, STRIPPED, {}, 0)]), PACK)
    sample = quality.bad_sample(gated).collect()
    assert len(sample) == quality.SAMPLE_ROWS
    first = sample[1]
    assert (first.body_bytes, len(first.head_hex), first.content_type) == (400, 600, "text/html")
    assert first.sample_name.endswith("auction_716_page_000__empty_short_body_400_bytes")
    report = {(r.reason, r.retryable): r.pages for r in quality.quarantine_report(gated).collect()}
    assert report == {("empty/short body (400 bytes)", True): 30, (quality.NO_MARKER, False): 1}

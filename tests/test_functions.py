import pytest
from pyspark.sql import functions as F

from helpers import scalar
from leafmill.functions import records, text, urls
from leafmill.sites.auctions import PACK

URLS, DOMAIN = PACK.urls, PACK.domains[0]
V = F.col("v")


@pytest.mark.parametrize(
    "given, iso",
    [
        ("11 июня 2026 года", "2026-06-11"),
        ("с 5\xa0МАЯ\xa02026", "2026-05-05"),
        ("31 февраля 2026", "2026-02-31"),
        ("5 брюмера 2026, 6 мая 2026", None),
        ("скоро", None),
        ("", None),
        (None, None),
    ],
)
def test_ru_date(spark, given, iso):
    assert scalar(spark, text.ru_date_iso(V.cast("string")), v=given) == iso


def test_clean_and_strip(spark):
    assert scalar(spark, text.clean_text(V), v="\xa0 a \t\n b\x1c ") == "a b"
    assert scalar(spark, text.strip_text(V), v="\xa0 a  b\n\n") == "a  b"
    assert scalar(spark, text.clean_text(V.cast("string")), v=None) == ""


@pytest.mark.parametrize(
    "given, utc",
    [
        ("2026-05-31T12:00:00+00:00", "2026-05-31 12:00:00"),
        ("2026-05-31T12:00:00Z", "2026-05-31 12:00:00"),
        ("2026-05-31T12:00:00+03:00", "2026-05-31 09:00:00"),
        ("2026-05-31 12:00:00.25", "2026-05-31 12:00:00.25"),
        ("2026-05-31", "2026-05-31 00:00:00"),
        ("2026-05-31T10", "2026-05-31 10:00:00"),
        ("2026-05-31 10+03:00", "2026-05-31 07:00:00"),
        ("12:00", "2030-01-01 00:00:00"),
        ("soon", "2030-01-01 00:00:00"),
        (None, "2030-01-01 00:00:00"),
    ],
)
def test_utc_time(spark, given, utc):
    now = F.lit("2030-01-01").cast("timestamp")
    assert scalar(spark, text.utc_time(V.cast("string"), now).cast("string"), v=given) == utc


def test_body_text(spark):
    assert scalar(spark, text.body_text(V), v=bytearray(b"a\xffb")) == "a�b"
    assert scalar(spark, text.body_text(V.cast("binary")), v=None) == ""


@pytest.mark.parametrize("given, number", [("1 234 ₽", 1234), ("18446744073709551615", 2**64 - 1), ("18446744073709551616", None), ("", None), ("нет", None), ("9" * 25, None)])
def test_digits(spark, given, number):
    assert scalar(spark, text.digits_to_number(V), v=given) == number


@pytest.mark.parametrize(
    "url, kind, group",
    [
        ("/auction/752/2/", "lot", "752"),
        ("/auction/709s1/84a/", "lot", "709s1"),
        ("/auction/739.2/", "catalog", "739.2"),
        ("/auction/752/?page=2", "catalog", "752"),
        ("/auction/archives/?page=1", "other", ""),
        ("/auction/752/x", "other", "752"),
        ("/auction/752", "other", ""),
    ],
)
def test_page_types(spark, url, kind, group):
    assert scalar(spark, urls.page_type(V, URLS), v=URLS.home + url) == kind
    assert scalar(spark, urls.group_id(V, URLS), v=URLS.home + url) == group


@pytest.mark.parametrize(
    "url, hit",
    [
        (f"{URLS.home}/auction/709s1/55/", True),
        (f"http://{DOMAIN}/auction/709s1/84a/", True),
        (f"{URLS.home}/auction/709s1/", False),
        (f"{URLS.home}/auction/709s1/55/?x", False),
        (f"https://evil.org/?u={URLS.home}/auction/709s1/55/", False),
    ],
)
def test_entry_urls(spark, url, hit):
    assert scalar(spark, V.rlike(URLS.any_entry), v=url) is hit
    assert (scalar(spark, urls.entry_group(V, URLS), v=url) == "709s1") is hit


@pytest.mark.parametrize(
    "url, canonical",
    [
        ("HTTPS://Ex.ORG", "https://ex.org/"),
        ("https://ex.org/P?b=2&a=1#frag", "https://ex.org/P?a=1&b=2"),
        ("https://ex.org/?a&&c=", "https://ex.org/?a=&c="),
        ("https://ex.org/?q=a%20b&p=%7e*", "https://ex.org/?p=~%2A&q=a+b"),
        ("https://ex.org/x?a=%zz", "https://ex.org/x?a=%zz"),
        ("https://ex.org/x?u=1=2", "https://ex.org/x?u=1%3D2"),
    ],
)
def test_canonical_url(spark, url, canonical):
    assert scalar(spark, urls.canonical_url(V), v=url) == canonical


def test_domains_and_files(spark):
    def inside(url):
        return scalar(spark, urls.in_domains(V, PACK.domains), v=url)

    assert inside(f"https://{DOMAIN}/x") and inside(f"http://a.{DOMAIN}:80/") and inside(f"https://u:p@{DOMAIN.upper()}")
    assert not inside(f"https://not{DOMAIN}/") and not inside(f"https://x.org/?{DOMAIN}")
    for url, is_file in (("http://h/a.PDF", True), ("http://h/a.tar.gz?x", True), ("http://h.py", False), ("http://h/a?x.pdf", False)):
        assert scalar(spark, urls.is_file(V), v=url) is is_file


def test_distinct_ids_keep_first_order(spark):
    html = "".join(f'<a href="/auction/{i}/">' for i in ("754", "743.1", "754", "archives", "752", "743.1"))
    assert scalar(spark, urls.distinct_ids(V, URLS), v=html + '<a href="/auction/752/2/">') == ["754", "743.1", "752"]
    assert scalar(spark, urls.distinct_ids(V.cast("string"), URLS), v=None) == []


def test_file_name(spark):
    assert scalar(spark, urls.file_name(V, 8), v="https://a.b/c?d") == "https_a_"


def test_content_key_ignores_key_order_and_spacing(spark):
    one = scalar(spark, records.content_key(V), v='{"a": "1", "b": ["x"]}')
    assert one == scalar(spark, records.content_key(V), v='{"b":["x"],"a":"1"}')
    assert one != scalar(spark, records.content_key(V), v='{"b":["x"],"a":"2"}')

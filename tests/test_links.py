from dataclasses import replace

from pyspark.sql import functions as F

from helpers import pages_of, raw_rows
from leafmill.operators import landing, links, url_index, worklists
from leafmill.sources import tables
from leafmill.sites.base import LinkRules
from leafmill.sites.auctions import PACK
from leafmill.sites.registry import get_site

QUOTES = get_site("quotes")
HOME = PACK.urls.home
MARKED = '<b data-lf-microdata="lot-name">x</b>'


def found(spark, body, rules, domains=(), url="https://quotes.toscrape.com/"):
    rows = links.page_links(pages_of(spark, [(url, body)]), rules, domains).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(len(rows)))
    return [r.dst_url for r in rows]


LISTING = """<a href="/login">Login</a><div class="quote"><a href="/author/Jane-Austen">(about)</a>
  <a class="tag" href="/tag/books/page/1/">books</a><a href="/tag/books/page/1/">again</a><a href="x.pdf">f</a></div>
  <ul><li class="next"><a href="/page/2/">Next</a></li></ul><a href="/tag/love/">love</a><a href="/page/9/">outside</a>"""


def test_rules_and_regions(spark):
    # The author rule wants a trailing slash, which these links lack.
    base = "https://quotes.toscrape.com"
    assert found(spark, LISTING, QUOTES.rules) == [f"{base}/tag/books/page/1/", f"{base}/page/2/"]
    assert found(spark, LISTING, LinkRules(allow=("/page/",))) == [f"{base}/{p}" for p in ("tag/books/page/1/", "page/2/", "page/9/")]
    assert found(spark, LISTING, LinkRules(allow=("/page/",), deny=("/tag/", "9"))) == [f"{base}/page/2/"]
    assert found(spark, LISTING, LinkRules(), ("other.org",)) == []


def test_regions_come_in_rule_order_and_overlap_once(spark):
    body = '<li class="next"><a href="/n"></a></li><div class="quote"><a href="/q"></a><div class="quote"><a href="/r"></a></div></div>'
    assert [u.rsplit("/", 1)[1] for u in found(spark, body, LinkRules(regions=QUOTES.rules.regions))] == ["q", "r", "n"]


def test_next_links(spark):
    assert [r.dst_url for r in links.next_links(pages_of(spark, [("https://q/page/1/", LISTING)])).collect()] == ["https://q/page/2/"]


def test_auction_page_gives_every_lot_and_page(spark):
    lots = "".join(f'<a href="{HOME}/auction/752/{i}/">x</a><a href="/auction/752/{i}/">y</a>' for i in range(1, 37))
    paging = "".join(f'<a href="?page={i}">p</a>' for i in range(2, 8))
    utility = '<a href="/auction/rules/">r</a><a href="/auction/archives/?page=2">a</a><a href="/auction/752/84a/">s</a>'
    got = set(found(spark, lots + paging + utility, PACK.rules, PACK.domains, f"{HOME}/auction/752/"))
    assert got == {f"{HOME}/auction/752/{i}/" for i in range(1, 37)} | {f"{HOME}/auction/752/?page={i}" for i in range(2, 8)}


def edges(spark, urls):
    return spark.createDataFrame([("s", i, u) for i, u in enumerate(urls)], "src_url string, pos int, dst_url string")


SCOPED = ["/auction/716/", "/auction/716/84a/", "/auction/716/?page=3", "/auction/743.1/2/"]
UNSCOPED = ["/auction/717/", "/auction/716/2/x", "/auction/7431/2/", "/auction/rules/", "/auction/716/?sort=1"]


def test_scoped_links(spark):
    crawl = edges(spark, [HOME + u for u in SCOPED + UNSCOPED] + ["https://o.org/auction/716/"])
    for ids in (["716", "743.1"], spark.createDataFrame([("716",), ("743.1",), ("716",)], "id string")):
        got = links.scoped_links(crawl, PACK, ids).orderBy("pos").collect()
        assert [r.dst_url for r in got] == [HOME + u for u in SCOPED]


def test_unique_requests(spark):
    asked = spark.createDataFrame([("http://a/x?b=1&a=2#f",), ("http://A/x?a=2&b=1",), ("http://a/y",)], "url string")
    got = {r.canonical_url: r.requests for r in links.unique_requests(asked).collect()}
    assert got == {"http://a/x?a=2&b=1": 2, "http://a/y": 1}


def stored(spark):
    rows = [
        ("/auction/716/1/", 200, MARKED),
        ("/auction/716/2/", 200, ""),
        ("/auction/716/2/", 404, ""),
        ("/auction/716/3/", 404, MARKED),
        ("/auction/717/4a/", 200, "stripped"),
        ("/auction/717/4a/", 200, MARKED),
        ("/auction/717/5/", 200, "stripped"),
        ("/auction/716/", 200, "catalogue"),
        ("/auction/weird/9/", 200, ""),
    ]
    raw = raw_rows(spark, [("2024-01-01 00:00:00", PACK.name, HOME + u, s, b) for u, s, b in rows])
    return raw.unionByName(raw_rows(spark, [("2024-01-01 00:00:00", "books", f"{HOME}/auction/716/8/", 200, "")]))


def paths(rows):
    return sorted(r.url.removeprefix(HOME) for r in rows.collect())


def test_heal_ignores_status_and_skip_needs_200(spark):
    plain = stored(spark)
    for raw in (plain, landing.landed(plain)):
        assert paths(worklists.heal_set(raw, PACK)) == ["/auction/716/2/", "/auction/717/5/"]
        assert paths(worklists.heal_set(raw, PACK, ["716", "718"])) == ["/auction/716/2/"]
        assert paths(worklists.heal_set(raw, PACK, ["weird"])) == ["/auction/weird/9/"]
        assert paths(worklists.good_entries(raw, PACK)) == ["/auction/716/1/", "/auction/717/4a/"]


def test_landed_marker_saves_reading_bodies(spark, tmp_path):
    from leafmill.sources import tables

    tables.append_raw(stored(spark), str(tmp_path / "raw"))
    raw = tables.read_raw(spark, str(tmp_path / "raw"))
    for plan in (worklists.heal_set(raw, PACK), worklists.good_entries(raw, PACK)):
        assert "body:string" not in plan._jdf.queryExecution().executedPlan().toString()
    assert paths(worklists.heal_set(raw, PACK)) == ["/auction/716/2/", "/auction/717/5/"]


def test_work_lists_from_the_url_index(spark, tmp_path):
    """Landed in two parts and one of them twice: same lists, and neither grouping nor anti join shuffles."""
    raw = stored(spark)
    for part in (F.col("url") < f"{HOME}/auction/717", F.col("url") >= f"{HOME}/auction/717", F.col("url") >= f"{HOME}/auction/717"):
        url_index.index_urls(raw.filter(part), PACK, "held_urls", 4, str(tmp_path / "held"))
    wanted = spark.createDataFrame([(f"{HOME}/auction/716/{n}/",) for n in (1, 1, 2, 3)], "dst_url string")
    for _ in range(2):
        url_index.index_targets(wanted, "wanted_urls", 4, str(tmp_path / "wanted"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        heal, good = url_index.urls_to_heal(spark, PACK, "held_urls"), url_index.good_urls(spark, PACK, "held_urls")
        fetch = url_index.targets_to_fetch(spark, PACK, "wanted_urls", "held_urls")
        for rows in (heal, good, fetch):
            rows.collect()
            assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        assert paths(heal) == paths(worklists.heal_set(raw, PACK)) == ["/auction/716/2/", "/auction/717/5/"]
        assert paths(good) == paths(worklists.good_entries(raw, PACK))
        assert paths(fetch) == paths(worklists.skip_held(wanted, raw, PACK)) == ["/auction/716/2/", "/auction/716/3/"]
        assert paths(url_index.urls_to_heal(spark, PACK, "held_urls", ["weird"])) == ["/auction/weird/9/"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE held_urls")
        spark.sql("DROP TABLE wanted_urls")


def test_work_lists_of_a_site_of_ones_own(spark, tmp_path):
    """Markers noted at landing, or looked up in the bodies where they were not."""
    own = replace(PACK, name="own")
    raw = stored(spark).withColumn("spider", F.when(F.col("spider") == PACK.name, "own").otherwise(F.col("spider")))
    for noted in (None, own):
        path = str(tmp_path / f"raw-{noted is None}")
        tables.append_raw(raw, path, noted)
        landed = tables.read_raw(spark, path)
        assert landed.filter("spider = 'own' and has_marker is null").count() == (0 if noted else landed.filter("spider = 'own'").count())
        assert paths(worklists.heal_set(landed, own)) == ["/auction/716/2/", "/auction/717/5/"]
        assert paths(worklists.good_entries(landed, own)) == ["/auction/716/1/", "/auction/717/4a/"]


def test_skip_held_lets_catalogue_pages_through(spark):
    crawl = edges(spark, [HOME + u for u in ("/auction/716/1/", "/auction/716/1/", "/auction/716/2/", "/auction/716/", "/auction/716/?page=2")])
    want = ["/auction/716/", "/auction/716/2/", "/auction/716/?page=2"]
    assert paths(worklists.skip_held(crawl, stored(spark), PACK)) == want
    assert paths(worklists.skip_held(crawl, stored(spark), PACK, ["717"])) == ["/auction/716/", "/auction/716/1/", *want[1:]]


def test_fetch_outcome(spark):
    targets = spark.createDataFrame([(f"{HOME}/auction/{u}/",) for u in ("716/1", "716/2", "716/2", "717/4a")], "url string")
    assert tuple(worklists.fetch_outcome(targets, stored(spark), PACK).first()) == (3, 2, 1)


def archive(spark, pages):
    rows = [(n, "".join(f'<a href="/auction/{i}/">' for i in ids)) for n, ids in pages.items()]
    return spark.createDataFrame(rows, "page int, html string")


def latest(spark, pages, n, **kw):
    return [(r.rank, r.auction_id) for r in worklists.latest_ids(archive(spark, pages), PACK, n, **kw).collect()]


def test_latest_ids(spark):
    pages = {1: ["9", "8", "9"], 2: ["8", "7s1"], 3: ["9", "7s1"], 4: ["1"]}
    assert latest(spark, pages, 2) == [(1, "9"), (2, "8")]
    assert latest(spark, pages, 10) == [(1, "9"), (2, "8"), (3, "7s1")]
    assert latest(spark, {1: ["9"], 3: ["8"]}, 10) == [(1, "9")]
    assert latest(spark, {1: ["9"], 2: ["8"]}, 10, max_pages=1) == [(1, "9")]
    assert latest(spark, {1: []}, 10) == []


def test_work_plan(spark):
    candidates = spark.createDataFrame([(1, "9"), (2, "8"), (3, "7")], "rank int, auction_id string")
    held = spark.createDataFrame([("8",), ("1",)], "auction_id string")
    assert [r.auction_id for r in worklists.work_plan(candidates, held).collect()] == ["9", "7"]
    assert [r.auction_id for r in worklists.work_plan(candidates, held, held=True).collect()] == ["8"]
    assert worklists.work_plan(candidates, None).count() == 3
    assert worklists.work_plan(candidates, None, held=True).count() == 0


def test_seeds_and_start_pages(spark):
    ids = spark.createDataFrame([("716",), ("743.1",)], "auction_id string")
    assert {r.url for r in worklists.seeds(ids, PACK).collect()} == {f"{HOME}/auction/716/", f"{HOME}/auction/743.1/"}
    assert [r.url for r in worklists.start_pages(ids, QUOTES).collect()] == list(QUOTES.start_urls)


def test_frontier_step(spark):
    pages = pages_of(spark, [("https://quotes.toscrape.com/", LISTING), ("https://quotes.toscrape.com/page/1/", LISTING)])
    known = spark.createDataFrame([("https://quotes.toscrape.com/page/2/",)], "url string")
    assert [r.url for r in worklists.frontier_step(pages, QUOTES, known).collect()] == ["https://quotes.toscrape.com/tag/books/page/1/"]
    body = '<a href="/x?b=2&a=1#one">1</a><a href="/x?a=1&b=2#two">2</a><a href="/y?q=%7Ea">3</a><a href="/y?q=~a">4</a>'
    page = pages_of(spark, [("https://quotes.toscrape.com/", body)])
    seen = spark.createDataFrame([("https://QUOTES.toscrape.com/x?a=1&b=2",)], "url string")
    assert [r.url for r in worklists.frontier_step(page, replace(QUOTES, rules=LinkRules()), seen).collect()] == ["https://quotes.toscrape.com/y?q=%7Ea"]
    open_rules = replace(QUOTES, rules=LinkRules())
    assert worklists.frontier_step(pages, open_rules, known).filter(F.col("url").endswith(".pdf")).count() == 0

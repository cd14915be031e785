"""Pages, records and links derived from the driver's tables, row by row and over whole tables.

Pages are written out by column expressions, one or more per table row, so making
them never groups, sorts or shuffles. `oracles.py` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.sites.auctions import PACK

HOME = PACK.urls.home


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows per partition that pages and records are made in: few enough for a task to sort its records in memory.
DEALT_ROWS = 250_000


def dealt(rows: DataFrame) -> DataFrame:
    """The driver's tables are single files of one row group; their narrow rows are dealt out before pages are made of them.

    A partition for each core, and more of them as the table grows: the count comes from the files' footers.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # Dealt by their place in the table: without a key Spark sorts all rows first, in the one task that reads a row group.
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    return placed.repartition(max(cores, -(-rows.count() // DEALT_ROWS)), "_place").drop("_place")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def cat(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def after_start(minutes: Column) -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=minutes)


# Raw pages from `pages`: five URL shapes, three statuses, marker on two of three, every 13th cut short.


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    group = text(F.floor(i / 10).cast("bigint"))
    url = (
        F.when(i % 5 == 0, cat(HOME, "/auction/", group, "/"))
        .when(i % 5 == 1, cat(HOME, "/auction/", group, "/?page=2"))
        .when(i % 5 == 4, cat(HOME, "/auction/archives/?page=1"))
        .otherwise(cat(HOME, "/auction/", group, "/", text(i % 2 + 1), "/"))
    )
    marker = F.when(i % 3 != 0, cat('<b data-lf-microdata="lot-name">Lot ', text(i), "</b>")).otherwise(F.lit(""))
    whole = cat(F.col("html"), marker)
    pages = dealt(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select(
        "page_id",
        after_start((i * 37).cast("int")).alias("fetched_at"),
        F.lit(PACK.name).alias("spider"),
        url.alias("url"),
        F.when(i % 11 == 0, 404).when(i % 17 == 0, 503).otherwise(200).alias("http_status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html")).alias("headers"),
        F.when(i % 13 == 0, F.substring(whole, 1, 200)).otherwise(whole).alias("body"),
        F.lit("{}").alias("payload"),
    )


# Parsed records from `orders` and `lineitem`.


def _envelope(url: Column, fetched: str, parsed: Column, record: Column, kind: str) -> list[Column]:
    return [
        F.lit(PACK.name).alias("spider"),
        url.alias("url"),
        F.col(fetched).alias("source_fetched_at"),
        parsed.alias("parsed_at"),
        F.to_json(record).alias("fields"),
        F.lit(kind).alias("record_type"),
    ]


def _auction_records(orders: DataFrame, later: bool) -> DataFrame:
    key = text("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "через 3 дня")
    ).otherwise("unknown")
    record = F.struct(
        F.lit("auction").alias("type"),
        key.alias("auction_id"),
        (F.lit("") if later else F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_iso"),
        (F.lit("unknown") if later else status).alias("status"),
    )
    parsed = F.col("o_orderdate") + F.expr("INTERVAL 1 DAY") if later else F.col("o_orderdate")
    rows = orders.filter(F.col("o_orderkey") % 3 == 0) if later else orders
    return rows.select(*_envelope(cat(HOME, "/auction/", key, "/"), "o_orderdate", parsed, record, "auction"))


def auction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order and, for every third, a later one that knows neither status nor date."""
    orders = dealt(table(spark, sf_dir, "orders"))
    return _auction_records(orders, False).unionAll(_auction_records(orders, True))


def money(column: str) -> Column:
    return cat(text(F.col(column).cast("decimal(18,2)")), " ₽")


def item_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per line item; prices and pictures come and go between the versions of a lot."""
    flag, line = F.col("l_returnflag"), text("l_linenumber")
    url = cat(HOME, "/auction/", text("l_orderkey"), "/", line, "/")
    sold = F.when(flag != "N", money("l_extendedprice"))
    record = F.struct(
        F.lit("item").alias("type"),
        text("l_orderkey").alias("auction_id"),
        line.alias("lot_number"),
        cat("Лот ", line).alias("lot_index"),
        cat("Part ", text("l_partkey")).alias("title"),
        F.when(F.col("l_suppkey") % 2 == 0, F.lit("")).otherwise(cat("From ", text("l_suppkey"))).alias("description"),
        money("l_extendedprice").alias("start_price"),
        F.when(F.col("l_linestatus") == "O", money("l_extendedprice")).alias("leading_bid"),
        sold.alias("final_price"),
        F.when(flag != "N", flag == "R").alias("reserve_not_met"),
        text(F.col("l_quantity").cast("int")).alias("views"),
        F.when(F.col("l_linenumber") % 2 == 0, F.array(cat("/img/", text("l_partkey"), ".jpg")))
        .otherwise(F.array().cast("array<string>"))
        .alias("images"),
        url.alias("source_url"),
    )
    rows = dealt(table(spark, sf_dir, "lineitem"))
    return rows.select(*_envelope(url, "l_shipdate", F.col("l_shipdate"), record, "item"))


def parsed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auction_records(spark, sf_dir).unionAll(item_records(spark, sf_dir))


# A raw stream from `events`, times cut to the hour so that many rows tie.


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("spider"),
        cat("https://example.org/e/", text("event_id")).alias("url"),
        F.col("props").alias("body"),
        F.date_trunc("hour", "ts").alias("fetched_at"),
    )


def event_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("spider"),
        F.col("ts").alias("watermark"),
        (F.date_trunc("day", F.col("ts")) + F.make_dt_interval(hours=hours)).alias("updated_at"),
    )


# Archive pages from `orders`: 36 ids a page, each linked twice; every 997th page repeats the one before.


def archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, html), the rows of a page put together in groups of 36 keys."""
    key = F.col("o_orderkey")
    page = F.floor(key / 36).cast("bigint") + 1
    shown = text(F.when(page % 997 == 0, key - 36).otherwise(key))
    link = cat(
        '<a class="tm-media-box" href="/auction/', shown, '/"></a><a href="', HOME, "/auction/", shown, '/">',
        shown, '</a><a href="/auction/rules/">rules</a>',
    )
    rows = table(spark, sf_dir, "orders").select(page.alias("page"), F.struct(key.alias("key"), link.alias("link")).alias("row"))
    html = F.array_join(F.transform(F.sort_array(F.collect_list("row")), lambda r: r["link"]), "\n")
    return rows.groupBy("page").agg(html.alias("html"))


# Markup pages, one per row of a table.

_HEAD = (
    '<!DOCTYPE html><html lang="ru"><head><meta charset="utf-8"><title>t</title><style>p{margin:0}</style>'
    '<script>var x = "<article class=\'tm-product-card\'>";</script>'
)


def quote_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing per conversation turn: one block per line of its text, plus an empty one."""
    block = lambda line: cat(
        '<div class="quote" itemscope><span class="text">\n ', line, ' </span><span>by <small class="author">',
        F.col("role"), "</small> <a href=\"/author/x\">(about)</a></span><div class='tags'>Tags:"
        '<meta class="keywords" content="k" /    > <a class="tag" href="/tag/a/page/1/">',
        F.col("role"), "</a>\n<a class=tag href=/tag/b/page/1/>turn&amp;", text("turn"), "</a></div></div>",
    )
    lines = F.transform(F.split("text", "\n"), block)
    body = cat(
        _HEAD, '</head><body><p>unclosed<div class="row"><a class="tag" href="/x">not a quote</a>',
        F.array_join(lines, "\n"), '</div><div class="quote"></div><ul><li class="next"><a href="/page/2/">Next</a></ul>',
    )
    rows = dealt(table(spark, sf_dir, "conversations"))
    url = cat("https://quotes.toscrape.com/page/", text("conv_id"), "/?turn=", text("turn"))
    return rows.select(
        F.lit("quotes").alias("spider"), url.alias("url"), body.alias("body"), after_start(F.col("turn").cast("int")).alias("fetched_at")
    )


def book_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing per part with one to three products."""
    words = F.array(*map(F.lit, ("One", "Two", "Three", "Four", "Five")))
    pod = lambda i: cat(
        '<li><article class="product_pod"><p class="star-rating ', F.get(words, (F.col("p_size") + i) % 5),
        '"><i class="icon-star"></i></p><h3><a href="catalogue/b_', text("p_partkey"), '/index.html" title=" ',
        F.col("p_name"), " &amp; ", text(i), ' ">short...</a></h3><div class="product_price"><p class="price_color">£',
        text(F.col("p_retailprice").cast("decimal(18,2)")), '</p>\n<p class="instock availability">',
        F.when(i % 2 == 0, F.lit("\n <i class=\"icon-ok\"></i>\n   In stock\n ")).otherwise(F.lit(" ")),
        "</p></div></article>",
    )
    pods = F.transform(F.sequence(F.lit(1), F.col("p_size") % 3 + 1), pod)
    body = cat(_HEAD, '</head><body><ol class="row">', F.array_join(pods, ""), "</ol></body></html>")
    url = cat("https://books.toscrape.com/catalogue/page-", text("p_partkey"), ".html")
    rows = dealt(table(spark, sf_dir, "part"))
    return rows.select(
        F.lit("books").alias("spider"), url.alias("url"), body.alias("body"), after_start(F.col("p_size")).alias("fetched_at")
    )


def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue page per order with up to five lot cards; every 7th page is blocked and shows nothing."""
    from leafmill.functions.text import RU_MONTHS

    key = F.col("o_orderkey")
    k = text(key)
    months = F.array(*map(F.lit, RU_MONTHS))
    date = cat(
        text(F.dayofmonth("o_orderdate")), "&nbsp;", F.get(months, F.month("o_orderdate") - 1), " ",
        text(F.year("o_orderdate")), "&nbsp;года",
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit('<span class="uk-label">Аукцион завершён</span>'))
        .when(F.col("o_orderstatus") == "O", cat('<span data-online="lf-', k, '-t-to-start">\n Через ', text(key % 30), " дней</span>"))
        .otherwise(F.lit(""))
    )
    card = lambda i: cat(
        '<article class="uk-card tm-product-card"><a class="tm-media-box" href="', HOME, "/auction/", k, "/", text(i),
        F.when(i == 5, F.lit("a")).otherwise(F.lit("")), '/"><figure class="tm-media-box-wrap"><img src="/i/', k, "-", text(i),
        '.jpg"></figure></a><div class="uk-text-meta uk-margin-xsmall-bottom">Лот ', text(i),
        '</div><h3 class="tm-product-card-title"><a href="/ignored/">Книга&nbsp;№ ', text(i), ' <i>том</i></a></h3>',
        '<div class="tm-product-card-prices"><div class="gap"></div><div class="uk-text-meta">Стартовая цена</div><div>',
        text(key + i * 1000), " <small>руб</small></div>",
        F.when(F.col("o_orderstatus") == "F", cat(
            '<div class="uk-text-meta">Финальная ставка',
            F.when(i % 2 == 0, F.lit(' <span class="tm-product-card-ndr">НДР</span>')).otherwise(F.lit("")),
            "</div><div>", text(key + i * 2000), "</div>",
        )).when(F.col("o_orderstatus") == "O", cat('<div class="uk-text-meta">Лидирующая ставка</div><div>', text(key + i * 1500), "</div>"))
        .otherwise(F.lit("")),
        '</div><span data-type="lot-views-cnt"> ', text(i * 7), "</span></article>",
    )
    cards = F.when(key % 6 == 0, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), (key % 6).cast("int")), card), "\n"))
    good = cat(
        '<section><h4>Серия ', F.col("o_orderpriority"), '</h4></section><div class="uk-display-inline-block"><div><small>Аукцион № ',
        k, ". Аукцион сезона</small></div><div><small>", date, "</small></div></div>", status,
        '<aside>Ближайшие <span data-online="lf-', text(key + 1), '-t-to-start">Завтра</span></aside>', cards,
    )
    body = cat(
        _HEAD, '<meta property="og:url" content="', HOME, "/auction/", k, '/"><meta property="og:description" content="Описание ',
        k, '"></head><body><p>x', F.when(key % 7 == 0, F.lit("<p>Access denied")).otherwise(good), "</body></html>",
    )
    url = cat(HOME, "/auction/", k, "/?page=1")
    rows = dealt(table(spark, sf_dir, "orders"))
    return rows.select(
        F.lit(PACK.name).alias("spider"), url.alias("url"), body.alias("body"), F.col("o_orderdate").alias("fetched_at")
    )


def lot_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lot page per line item; every tenth part was not found and shows no lot."""
    k, n, part = text("l_orderkey"), text("l_linenumber"), text("l_partkey")
    micro = lambda tag, name, inner: cat(f'<{tag} data-lf-microdata="{name}">', inner, f"</{tag}>")
    when = lambda test, then: F.when(test, then).otherwise(F.lit(""))
    lot = cat(
        micro("h5", "lot-name", F.when(F.col("l_suppkey") % 5 == 0, F.lit(" ")).otherwise(cat("\n Книга &laquo;", part, "&raquo;&nbsp; "))),
        micro("h2", "lot-index", cat("Лот ", n)),
        when(F.col("l_linestatus") == "O", micro("div", "lot-desc", cat("<p>Том ", n, "<p>Вторая <b>строка</b> текста<!-- x -->"))),
        micro("span", "lot-start-price", cat(part, " 000")),
        when(F.col("l_returnflag") != "N", cat('<div class="a tm-product-price-final">', part, " 500 <small>руб</small></div>")),
        when(F.col("l_linenumber") % 2 == 0, cat('<a data-lf-microdata="lot-image" href="/i/', part, '.jpg"><img src=x></a>')),
    )
    body = cat(
        _HEAD, '<meta property="og:url" content="', HOME, "/auction/", k, "s1/", n, 'b/"><meta property=og:title content="Лот части ',
        part, '"><meta property="og:description" content="Кратко ', part, '"><meta property="og:image" content="/og/', part,
        '.png"></head><body>', F.when(F.col("l_partkey") % 10 == 0, F.lit("<p>лот не найден")).otherwise(lot),
        '<span data-type="lot-views-cnt">', text(F.col("l_quantity").cast("int")), "</span></body></html>",
    )
    rows = dealt(table(spark, sf_dir, "lineitem"))
    url = cat(HOME, "/auction/", k, "/", n, "/")
    return rows.select(
        F.lit(PACK.name).alias("spider"), url.alias("url"), body.alias("body"), F.col("l_shipdate").alias("fetched_at")
    )


# Three fetches of a lot and its catalogue page per customer, months apart; the newest text is the smallest.


def refetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = text("c_custkey"), F.col("v")
    title = cat(F.get(F.array(*map(F.lit, ("Z old", "M mid", "A new"))), v), " ", k)
    lot = cat(
        _HEAD, '</head><body><h5 data-lf-microdata="lot-name">', title, '</h5><span data-lf-microdata="lot-start-price">',
        F.get(F.array(*map(F.lit, ("900", "1200", "1000"))), v), "</span></body></html>",
    )
    # Completed at first and blocked later; the date is shown in the middle only.
    label = F.when((v == 0) & (F.col("c_custkey") % 3 == 0), F.lit('<span class="uk-label">Аукцион завершён</span>')).otherwise(
        cat('<span data-online="lf-', k, '-t-to-start">Через ', text(3 - v), " дней</span>")
    )
    date = F.when(v == 1, F.lit("<div><small>6 мая 2024 года</small></div>")).otherwise(F.lit(""))
    catalog = cat(
        _HEAD, '</head><body><div class="uk-display-inline-block"><div><small>Аукцион № ', k, "</small></div>", date, "</div>", label, "</body></html>"
    )
    pages = F.array(
        F.struct(cat(HOME, "/auction/", k, "/1/").alias("url"), lot.alias("body")), F.struct(cat(HOME, "/auction/", k, "/").alias("url"), catalog.alias("body"))
    )
    rows = dealt(table(spark, sf_dir, "customer").select("c_custkey")).withColumn("v", F.explode(F.lit([0, 1, 2])))
    return rows.select("v", F.inline(pages)).select(
        (F.lit("2024-01-10").cast("timestamp") + F.make_dt_interval(days=F.col("v") * 25)).alias("fetched_at"),
        F.lit(PACK.name).alias("spider"),
        "url",
        F.lit(200).alias("http_status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html")).alias("headers"),
        "body",
        F.lit("{}").alias("payload"),
    )


# Link edges and JSONL lines from `pages`.


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between the raw pages' URLs: lots, catalogue pages and a few links off the site."""
    i = F.col("page_id")
    group = text(F.floor(i / 10).cast("bigint"))
    targets = F.array(
        cat(HOME, "/auction/", group, "/", text(i % 4 + 1), "/"),
        cat(HOME, "/auction/", group, "/?page=", text(i % 3 + 1)),
        cat(HOME, "/auction/", group, "/"),
        cat("https://other.example.org/auction/", group, "/"),
        cat(HOME, "/auction/rules/"),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", F.posexplode(targets).alias("pos", "dst_url"))
    return pages.select(cat(HOME, "/p/", text(i)).alias("src_url"), "pos", "dst_url")


def jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export lines with every kind of gap: missing time, spider, status, headers, body, payload."""
    i = F.col("page_id")
    time = F.date_format(after_start((i * 37).cast("int")), "yyyy-MM-dd'T'HH:mm:ss")
    line = F.struct(
        F.when(i % 4 == 0, cat(time, "+03:00")).when(i % 4 == 1, cat(time, "Z")).when(i % 4 == 2, time).alias("fetched_at"),
        F.when(i % 5 == 0, F.lit("")).when(i % 5 != 1, F.lit("shop")).alias("spider"),
        F.when(i % 6 != 0, F.col("url")).alias("url"),
        F.when(i % 7 != 0, (i % 3 * 100 + 200).cast("int")).alias("http_status"),
        F.when(i % 3 != 0, F.create_map(F.lit("Content-Type"), F.lit("text/html"))).alias("headers"),
        F.when(i % 8 != 0, F.col("html")).alias("body"),
        F.when(i % 9 != 0, F.struct(i.alias("id"))).alias("payload"),
    )
    return table(spark, sf_dir, "pages").select(F.to_json(line).alias("value"))


# A graph of pages from `part`: each links to two others further on, back to the one it hangs from, and out of the site.

GRAPH = "https://graph.example.com/n/"


def graph_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")

    def link(target: Column, rest: str = "") -> list:
        return ['<a href="', GRAPH, text(target.cast("bigint")), f'{rest}">x</a>']

    body = cat(*link(key * 2), *link(key * 2 + 1, "#part"), *link(F.floor(key / 2)), *link(key * 2, "?"), '<a href="https://else.example.com/">y</a>')
    return dealt(table(spark, sf_dir, "part").select(cat(GRAPH, text("p_partkey")).alias("url"), body.alias("body")))

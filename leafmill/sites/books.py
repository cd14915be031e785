"""Book catalogue: one record per product block."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import markup as m
from leafmill.functions.text import blank_to_null, strip_text
from leafmill.sites.base import LinkRules, SitePack


def _first_match(values: Column, pattern: str, group: int) -> Column:
    found = F.transform(values, lambda v: blank_to_null(F.regexp_extract(v, pattern, group)))
    return m.first(F.filter(found, lambda v: v.isNotNull()))


def extract(nodes: Column, url: Column) -> Column:
    def record(block: Column) -> Column:
        heading = m.pick(block, m.element("h3"), m.element("a"))
        price = m.pick(block, m.element("p", ["price_color"]))
        stock = m.pick(block, m.element("p", ["instock", "availability"]))
        rating = m.pick(block, m.element("p", ["star-rating"]))
        return F.struct(
            strip_text(m.first(m.attr_values(heading, "title"))).alias("title"),
            strip_text(m.first(m.own_texts(block, price))).alias("price"),
            _first_match(m.own_texts(block, stock), r"(?U)[^\s\x1c-\x1f]+", 0).alias("availability"),
            _first_match(m.attr_values(rating, "class"), r"(?U)star-rating (\w+)", 1).alias("rating"),
            url.alias("source_url"),
        )

    blocks = m.pick(nodes, m.element("article", ["product_pod"]))
    return F.transform(blocks, lambda b: m.let(m.subtree(nodes, b), record))


# Site addresses and link patterns.
PACK = SitePack(
    name="books",
    domains=("books.toscrape.com",),
    start_urls=("https://books.toscrape.com/",),
    rules=LinkRules(
        allow=(
            r"catalogue/page-\d+\.html",
            r"catalogue/category/books/.*",
            r"catalogue/[^/]+_\d+/index\.html",
        ),
        regions=(("article", "product_pod"), ("li", "next")),
    ),
    extract=extract,
    attributes=("class", "title"),
)

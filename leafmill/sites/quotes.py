"""Quotation listing: one record per quote block."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import markup as m
from leafmill.functions.text import strip_text
from leafmill.sites.base import LinkRules, SitePack


def extract(nodes: Column, url: Column) -> Column:
    def record(block: Column) -> Column:
        def own(tag: str, cls: str) -> Column:
            return strip_text(m.first(m.own_texts(block, m.pick(block, m.element(tag, [cls])))))

        tags = m.pick(block, m.element("div", ["tags"]), m.element("a", ["tag"]))
        return F.struct(
            own("span", "text").alias("text"),
            own("small", "author").alias("author"),
            m.own_texts(block, tags).alias("tags"),
            url.alias("source_url"),
        )

    blocks = m.pick(nodes, m.element("div", ["quote"]))
    return F.transform(blocks, lambda b: m.let(m.subtree(nodes, b), record))


# Site addresses and link patterns.
PACK = SitePack(
    name="quotes",
    domains=("quotes.toscrape.com",),
    start_urls=("https://quotes.toscrape.com/",),
    rules=LinkRules(
        allow=(r"/page/\d+/", r"/tag/[^/]+/page/\d+/", r"/author/[^/]+/"),
        regions=(("div", "quote"), ("li", "next")),
    ),
    extract=extract,
)

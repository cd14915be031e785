"""The link graph: links of pages by rule, scope and domain, and requests without repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import markup as m
from leafmill.functions.text import blank_to_null, body_text
from leafmill.functions.urls import any_match, canonical_url, in_domains, is_file
from leafmill.sites.base import LinkRules, SitePack


def _page_links(nodes: Column, rules: LinkRules) -> Column:
    """Absolute links of a page, or of its regions in the order the rules name them, each once."""

    def linked(part: Column) -> Column:
        return F.transform(F.filter(part, lambda n: n["link"].isNotNull()), lambda n: n["link"])

    if not rules.regions:
        return F.array_distinct(linked(nodes))
    regions = (m.pick(nodes, m.element(tag, [cls] if cls else [])) for tag, cls in rules.regions)
    found = [F.flatten(F.transform(r, lambda root: linked(m.subtree(nodes, root)))) for r in regions]
    return F.array_distinct(F.concat(*found))


def followed(url: Column, rules: LinkRules, domains: Sequence[str] = ()) -> Column:
    """Whether a link is followed: some allow pattern, no deny pattern, no file, inside the domains."""
    keep = ~is_file(url)
    if rules.allow:
        keep = keep & any_match(url, rules.allow)
    if rules.deny:
        keep = keep & ~any_match(url, rules.deny)
    return keep & in_domains(url, domains) if domains else keep


def page_links(pages: DataFrame, rules: LinkRules, domains: Sequence[str] = ()) -> DataFrame:
    """Edges (src_url, pos, dst_url) of pages (url, body); `pos` counts a page's kept links from 0."""
    narrow = pages.select("url", "body")
    # Nothing but the regions and the links is looked at.
    split = m.page_nodes(body_text(F.col("body")), F.col("url"), links=True, only=rules.regions)
    nodes = narrow.select(F.col("url").alias("src_url"), split.alias("nodes"))
    kept = F.filter(_page_links(F.col("nodes"), rules), lambda u: followed(u, rules, domains))
    # Exploded as an expression, not as a column: no filter is inferred that would split pages twice.
    return nodes.select("src_url", F.posexplode(kept).alias("pos", "dst_url"))


def next_links(pages: DataFrame) -> DataFrame:
    """Edges to the next page of a listing."""
    return page_links(pages, LinkRules(regions=(("li", "next"),)))


def in_scope(rows: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose `scope_id` is among the group ids: a list, or the first column of a table of any size.

    The ids are made distinct together with their length, although the id alone decides
    it: the semi join then has an exchange of its own on both sides, which lets adaptive
    execution broadcast a short list and split the rows of a hot group.
    """
    if not isinstance(ids, DataFrame):
        ids = rows.sparkSession.createDataFrame([(str(i),) for i in ids], "id string")
    scope = ids.select(F.col(ids.columns[0]).cast("string").alias("scope_id"))
    distinct = scope.select("scope_id", F.length("scope_id").alias("n")).distinct().select("scope_id")
    return rows.join(distinct, "scope_id", "left_semi").drop("scope_id")


def scoped_links(links: DataFrame, pack: SitePack, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Links a crawl limited to some groups follows: their pages, paging and entries, on the site's domains."""
    scope = F.regexp_extract("dst_url", pack.urls.scoped_link, 1)
    mine = links.filter(in_domains(F.col("dst_url"), pack.domains)).withColumn("scope_id", blank_to_null(scope))
    return in_scope(mine.filter(F.col("scope_id").isNotNull()), ids)


def unique_requests(requests: DataFrame, url: str = "url") -> DataFrame:
    """One row per canonical URL: the spelling to fetch and how often it was asked for."""
    spelled = requests.select(canonical_url(F.col(url)).alias("canonical_url"), F.col(url).alias("url"))
    return spelled.groupBy("canonical_url").agg(F.min("url").alias("url"), F.count("*").alias("requests"))

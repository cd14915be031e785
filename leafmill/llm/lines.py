"""Lines that a host repeats over its pages, found by their share of the host's pages and dropped.

Everything is DataFrame functions. Counting sends each distinct page's line hashes, and
(host, line hash) pairs that were summed before the shuffle; texts themselves are never
shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import SPACES, stored

# A line on more than this share of a host's pages is boilerplate.
MAX_RATIO = 0.1
# Pages without the line that every host is taken to have besides its own, so that a few pages in common are no
# boilerplate of a small host: a line must be on more than MAX_RATIO * (pages + PRIOR_PAGES) pages.
PRIOR_PAGES = 20


def boilerplate(docs: DataFrame, max_ratio: float = MAX_RATIO, prior_pages: int = PRIOR_PAGES) -> DataFrame:
    """Per host with such lines: `host`, and `common`, the hashes of its boilerplate lines.

    A page is a distinct text of the host, so that exact copies of a page make none of its
    lines frequent. A host has at most (mean lines per page) / max_ratio lines here,
    however many pages it has. Blank lines are never boilerplate.
    """
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.translate(x, SPACES, "") != "")
    hashes = F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))
    text = F.coalesce("text", F.lit(""))
    pages = docs.select(F.col("source").alias("host"), F.xxhash64(text).alias("page"), F.octet_length(text).alias("bytes"), hashes.alias("lines"))
    once = pages.groupBy("host", "page", "bytes").agg(F.first("lines").alias("lines"))
    # Each page also counts under null, which makes the host's total one more line of the same aggregate.
    seen = once.select("host", F.explode(F.array_append("lines", F.lit(None).cast("long"))).alias("line"))
    counts = stored(seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("hits")).filter((F.col("hits") > max_ratio * prior_pages) | F.col("line").isNull()), "line-counts")
    totals = counts.filter("line is null").select(F.col("host").alias("of"), F.col("hits").alias("pages"))
    often = counts.filter("line is not null").join(totals, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("hits") > max_ratio * (F.col("pages") + prior_pages))
    return often.groupBy("host").agg(F.collect_list("line").alias("common"))


def without_boilerplate(docs: DataFrame, **limits: float) -> DataFrame:
    """The documents with their hosts' boilerplate lines taken out of `text`; every row and column stays.

    A null source is a host of its own; null texts stay null; a text of boilerplate only
    becomes empty; repeated rows are one page, and all of them lose the same lines;
    further columns pass through whatever their names; no rows give no rows. The lists of
    lines are stored first, so that Spark broadcasts them if their files are small and
    splits the hot hosts of a shuffled join if not.
    """
    return _rewritten(docs, **limits).select("row.*").select(*docs.columns)


def _let(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _kept(lines: Column, common: Column) -> Column:
    """The lines whose hash is not among `common`.

    The hashes that the page and its host have in common come from one set operation;
    they are dealt into as many lists as the root of their number, and a line is looked
    up in one of these.
    """

    def without(hits: Column) -> Column:
        lists = F.greatest(F.ceil(F.sqrt(F.size(hits))), F.lit(1)).cast("long")

        def looked_up(n: Column) -> Column:
            dealt = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda b: F.filter(hits, lambda h: F.pmod(h, n) == b))
            return _let(dealt, lambda d: F.filter(lines, lambda x: ~F.array_contains(F.element_at(d, (F.pmod(F.xxhash64(x), n) + 1).cast("int")), F.xxhash64(x))))

        return F.when(F.size(hits) == 0, lines).otherwise(_let(lists, looked_up))

    return _let(F.array_intersect(F.transform(lines, lambda x: F.xxhash64(x)), common), without)


def _rewritten(docs: DataFrame, **limits: float) -> DataFrame:
    hosts = stored(boilerplate(docs, **limits), "line-boilerplate")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    met = rows.join(hosts, F.col("row.source").eqNullSafe(F.col("host")), "left")
    lines = F.split(F.col("row.text"), "\n")
    kept = F.when(F.col("common").isNotNull() & F.col("row.text").isNotNull(), _kept(lines, F.col("common")))
    found = met.select("row", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), kept.alias("kept"))
    return found.select(
        F.col("row").withField("text", F.when(F.col("kept").isNull(), F.col("row.text")).otherwise(F.array_join("kept", "\n"))).alias("row"),
        "n_lines",
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"),
    )


def line_report(docs: DataFrame, **limits: float) -> DataFrame:
    """Per document: lines, lines removed, and the SHA-256 of what is left (null text: of the empty text).

    Nulls, repeated rows and empty tables are as in `without_boilerplate`.
    """
    return _rewritten(docs.select("doc_id", "text", "source"), **limits).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256")
    )

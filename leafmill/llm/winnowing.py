"""Document fingerprints by winnowing.

A window of `k` words moves over the text and gives one hash per place, made from the
hashes of its words (each word is hashed once). Of every `w` consecutive grams the
smallest is chosen, the rightmost on ties, and the chosen hashes are kept with their
places. Any run of k + w - 1 words that two texts share contains a whole window of
grams, so both texts choose the same hash there: that is the match guarantee, and the
kept places say where. Everything is DataFrame functions, and a text is fingerprinted
inside its row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.markup import let
from leafmill.llm.common import stored, words

K = 5
# A power of two: window minima are found by doubling.
W = 4
# Documents that are put in order together: about so many, until there are PARTS * PARTS buckets.
BUCKET_ROWS = 1024
# Ranges of ids that all documents are cut into, and again each of these, at most.
PARTS = 1024


def grams(tokens: Column, k: int = K) -> Column:
    """One hash per k words; a shorter text that has words is one gram."""

    def of(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*(h[i + j] for j in range(k))))
        short = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= k, each).otherwise(short)

    return let(F.transform(tokens, lambda x: F.xxhash64(x)), of)


def chosen(hashes: Column, w: int = W) -> Column:
    """Places of the chosen grams, ascending; fewer than `w` grams are one window."""
    stamped = F.transform(hashes, lambda x, i: F.struct(x.alias("h"), (-i).alias("back")))

    def minima(low: Column, reach: int) -> Column:
        if reach == w:
            return F.transform(low, lambda x: -x["back"])
        n = F.size(low) - reach
        wider = F.zip_with(F.slice(low, F.lit(1), n), F.slice(low, F.lit(reach + 1), n), lambda a, b: F.least(a, b))
        return let(wider, lambda x: minima(x, 2 * reach))

    whole = F.when(F.size(hashes) > 0, F.array(-F.array_min(stamped)["back"])).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.when(F.size(hashes) >= w, let(stamped, lambda s: minima(s, 1))).otherwise(whole))


def fingerprint(text: Column) -> Column:
    """`struct<hashes: array<long>, print: string>`: the set of chosen hashes, and `hash:place` of each in order."""

    def picked(h: Column, places: Column) -> Column:
        prints = F.transform(places, lambda p: F.concat(F.hex(h[p]), F.lit(":"), p.cast("string")))
        return F.struct(F.array_distinct(F.transform(places, lambda p: h[p])).alias("hashes"), F.array_join(prints, " ").alias("print"))

    return let(grams(words(text)), lambda h: let(chosen(h), lambda places: picked(h, places)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def _bounds(ids: DataFrame) -> tuple[list[int], list[int], DataFrame, bool]:
    """The least id of every part, the buckets of each, the least ids of a part's buckets as (part, bounds); whether an id is null.

    Ids cut the documents into parts of about equal rows, and ids of a part cut it into
    buckets of about BUCKET_ROWS. Only the id column is read; PARTS ids come to the
    driver, and the table has at most PARTS rows of PARTS ids.
    """
    rows, least, nulls = ids.agg(F.count("doc_id"), F.min("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    wanted = max(1, rows // BUCKET_ROWS)
    parts = min(PARTS, math.ceil(math.sqrt(wanted)))
    each = min(PARTS, math.ceil(wanted / parts))

    def cuts(n: int) -> Column:
        shares = [i / n for i in range(1, n)]
        found = F.percentile_approx("doc_id", shares, max(10_000, 4 * n)) if shares else F.array().cast("array<bigint>")
        return F.array_sort(F.array_distinct(F.concat(F.array(F.min("doc_id").cast("bigint")), found.cast("array<bigint>"))))

    named = ids.filter(F.col("doc_id").isNotNull())
    first = named.agg(cuts(parts)).first()[0] if rows else [0]
    inner = named.groupBy(_last_bound(F.col("doc_id"), F.lit(first)).alias("part")).agg(cuts(each).alias("bounds"))
    inner = stored(inner, "winnowing-bounds")
    sizes = dict(inner.select("part", F.size("bounds")).collect())
    return first, [sizes.get(part, 1) for part in range(len(first))], inner, nulls > 0


def _last_bound(doc_id: Column, bounds: Column) -> Column:
    """The place of the last bound not above the id, by binary search; 0 for a null id or no bounds."""
    steps = [1 << i for i in reversed(range(PARTS.bit_length()))]

    def step(at: Column, jump: Column) -> Column:
        return F.when((at + jump < F.size(bounds)) & (F.get(bounds, at + jump) <= doc_id), at + jump).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and `next_text` by ascending doc_id, the first after the last; `bucket`, `guest` as below.

    Buckets are ranges of ids. The first document of a bucket is also sent to the bucket
    before it as a guest (the first of all to the last bucket), so that each bucket knows
    every successor, and texts are shuffled once.
    """
    least, sizes, inner, nulls = _bounds(docs.select("doc_id"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _last_bound(F.col("doc_id"), F.lit(least)).alias("part"))
    # At most PARTS * PARTS ids, 8 MB.
    near = rows.join(F.broadcast(inner), "part", "left")
    at = _last_bound(F.col("doc_id"), F.col("bounds"))
    leads = F.get("bounds", F.col("at")) == F.col("doc_id")
    homed = near.withColumn("at", at).select("doc_id", "text", "part", "at", F.coalesce(leads, F.lit(False)).alias("leads"))
    # Buckets are numbered through, so that the one before is known.
    before = [sum(sizes[:part]) for part in range(len(sizes))]
    home = (F.get(F.lit(before), F.col("part")) + F.col("at")).cast("int")
    first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == least[0]
    place = lambda bucket, guest: F.struct(bucket.cast("int").alias("bucket"), F.lit(guest).alias("guest"))
    places = F.array_compact(
        F.array(
            place(F.col("home"), False),
            F.when(F.col("leads") & (F.col("home") > 0), place(F.col("home") - 1, True)),
            F.when(first, place(F.lit(sum(sizes) - 1), True)),
        )
    )
    placed = homed.withColumn("home", home).select("doc_id", "text", F.inline(places))
    return placed.withColumn("next_text", F.lead("text").over(_order()))


def _order():
    return Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprints of its text and its edited text, their likeness, and that to the next document.

    The edited text has the last quarter of the code points replaced by the beginning of
    the next document by doc_id (the first after the last; a lone document is its own
    next). Null texts are empty; texts without words have an empty fingerprint, alike
    only to another empty one; repeated ids follow each other by text; null ids come
    first; columns other than doc_id and text are left aside; no rows give no rows.
    """
    ordered = with_next(docs).withColumn("own", fingerprint(F.col("text")))
    paired = ordered.withColumn("next_hashes", F.lead(F.col("own")["hashes"]).over(_order())).filter(~F.col("guest"))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    both = paired.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_hashes", edited.alias("edited"))
    made = both.withColumn("changed", fingerprint(F.col("edited")))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("own")["print"].alias("fingerprint"),
        F.col("changed")["print"].alias("edited_fingerprint"),
        likeness(F.col("own")["hashes"], F.col("changed")["hashes"]).alias("near_edited"),
        likeness(F.col("own")["hashes"], F.col("next_hashes")).alias("near_next"),
    )

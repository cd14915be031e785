"""Shards by weighted rendezvous hashing: every shard bids for a record's key, and the best bid takes it.

A bid is -ln(u) / weight, where u in (0, 1) is a hash of key and shard; the least bid
wins, so that a shard's share is its weight's. Nothing else decides: a shard more, or
one of more weight, takes records only into itself, and what a lost shard held is
spread over the others. Everything is DataFrame functions, and placing needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.common import stored, stored_count

# Bits of a hash: the first 13 hex digits of an MD5.
BITS = 52
# Groups of equal rows per bucket of a shard's order, about.
BUCKET_ROWS = 4096
# Copies of one row that are numbered together.
COPIES = 4096
# Bytes per file that a shard is written in, about.
FILE_BYTES = 256 << 20


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def record_key(*columns: str) -> Column:
    """The columns as one text; null and empty are the same."""
    return F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to len(weights) - 1, that a key belongs to; of equal bids the lower shard's counts."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive, and there must be one at least")
    share = F.array(*(F.lit(float(w)) for w in weights))

    def bid(weight: Column, shard: Column) -> Column:
        u = (_hash(F.concat(key, F.lit("@"), shard.cast("string"))) + 0.5) / F.lit(float(1 << BITS))
        return F.struct((-F.ln(u) / weight).alias("bid"), shard.alias("shard"))

    return F.array_min(F.transform(share, bid)).getField("shard")


def sharded(docs: DataFrame, weights: Sequence[float], key: Sequence[str] = ("doc_id",), name: str = "shard") -> DataFrame:
    """The rows with their shard as a further column, which replaces one of that name. Rows stay where they are."""
    return docs.withColumn(name, shard_of(record_key(*key), weights))


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key: Sequence[str] = ("doc_id",)) -> None:
    """The rows as Parquet, a folder `shard=n` for each shard that has any, in files of about FILE_BYTES.

    A shard is dealt over as many tasks as it has files' worth of text, by a hash of
    the whole row's key and text, so that a heavy shard or key is no single task's.
    """
    placed = sharded(docs, weights, key)
    # Bounded by the number of shards.
    sizes = placed.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("bytes")).collect()
    files = max((-(-r["bytes"] // FILE_BYTES) for r in sizes), default=1)
    slice_ = F.pmod(F.xxhash64(*key, "text", F.rand(7)), F.lit(files))
    tasks = max(1, sum(-(-r["bytes"] // FILE_BYTES) for r in sizes))
    placed.repartition(tasks, "shard", slice_).write.partitionBy("shard").parquet(path)


def placements(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Shards are of equal weight and the key is doc_id alone, so `law` is 'key'; `grown_shard`
    is the shard with one shard more. `size` is the text's UTF-8 bytes plus 1. Slots
    number a shard's documents from 0 in the order of a hash of id, size and checksum.

    A null text has no bytes and the checksum of the empty text; all rows without an id
    have the same key; repeated rows are documents of their own, in neighbouring slots;
    other columns are left aside; no rows give no rows. Equal rows are counted before
    the shuffle and numbered in runs, and rows of one id differ in their place of the
    order, so that no row, id or shard, however frequent, is one task's work.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    key = record_key("doc_id")
    rows = rows.withColumns(
        {
            "shard": shard_of(key, [1.0] * shards),
            "grown_shard": shard_of(key, [1.0] * (shards + 1)),
            "order": _hash(record_key("doc_id", "size", "text_crc32")),
        }
    )
    alike = stored(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "shard-rows")
    bits = min(BITS - 1, max(0, (stored_count(alike) // BUCKET_ROWS).bit_length()))
    alike = alike.withColumn("bucket", F.shiftright("order", BITS - bits))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = alike.groupBy("shard", "bucket").agg(F.sum("copies").alias("held"))
    offsets = sums.select("shard", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("order", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    placed = alike.join(offsets, ["shard", "bucket"]).withColumn("first", first)
    runs = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    last = F.least(F.col("copies"), F.col("run") + COPIES) - 1
    slots = runs.withColumn("slot", F.explode(F.sequence(F.col("first") + F.col("run"), F.col("first") + last)))
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

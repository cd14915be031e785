"""Best-fit packing of documents into fixed-length bins under conflicts.

A bin holds at most one document of a duplicate cluster and at most two of a source; it
carries those as bitmaps, in which two clusters or sources may share a bit (which only
keeps them apart as well). Pieces are packed in shards of bounded size, the longest
first: the search begins at the tightest bin that has room and goes on to the next
larger residual until a bin without conflict is found. Every residual knows what all of
its bins have in common, so that a piece in conflict with all of them passes them by at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored, stored_count, words
from leafmill.llm.jaccard import grouped
from leafmill.llm.tokens import python_ready

CAPACITY = 2048
# Pieces packed together, about; a hash deals them, so a hot source or cluster is spread evenly.
SHARD_ROWS = 8192
CLUSTER_BITS, SOURCE_BITS = 512, 64


def pack(lengths: np.ndarray, clusters: np.ndarray, sources: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces come longest first, none longer than the capacity."""
    bins: list[list[int]] = []  # cluster bitmap, bitmap of sources held once, of sources held twice
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    # Clusters, and sources held twice, that all bins of a residual have; fewer where a bin has left since.
    shared: list[list[int]] = [[-1, -1] for _ in range(capacity + 1)]
    present = 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        cluster, source = 1 << int(clusters[i]), 1 << int(sources[i])
        fit, room = -1, length
        rest = present >> length
        while rest:
            step = (rest & -rest).bit_length() - 1
            room += step
            if not (shared[room][0] & cluster or shared[room][1] & source):
                clusters_of_all = sources_of_all = -1
                for place, b in enumerate(open_at[room]):
                    held = bins[b]
                    if not (held[0] & cluster or held[2] & source):
                        fit = b
                        break
                    clusters_of_all &= held[0]
                    sources_of_all &= held[2]
                if fit >= 0:
                    open_at[room].pop(place)
                    if not open_at[room]:
                        present &= ~(1 << room)
                        shared[room] = [-1, -1]
                    break
                shared[room] = [clusters_of_all, sources_of_all]
            rest >>= step + 1
            room += 1
        if fit < 0:
            fit, room = len(bins), capacity
            bins.append([0, 0, 0])
        held = bins[fit]
        held[2] |= held[1] & source
        held[0] |= cluster
        held[1] |= source
        where[i], offset[i] = fit, capacity - room
        if room > length:
            open_at[room - length].append(fit)
            shared[room - length][0] &= held[0]
            shared[room - length][1] &= held[2]
            present |= 1 << (room - length)
    return where, offset


def _packer(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["shard"]):
            shard, lengths, clusters, sources = (group.column(c).to_numpy() for c in ("shard", "length", "cluster", "bit"))
            where, offset = pack(lengths, clusters, sources, capacity)
            made = group.select(["doc_id", "source", "piece", "start", "length"])
            made = made.append_column("bin", pa.array((shard << 32) + where)).append_column("position", pa.array(offset))
            yield from made.combine_chunks().to_batches()

    return run


def text_cluster(text: Column) -> Column:
    """A hash that texts share if their words are the same but for case and spacing."""
    return F.xxhash64(F.lower(F.array_join(words(text), " ")))


def packed(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None) -> DataFrame:
    """One row per piece: doc_id, source, piece, start and length (in words), bin, and the position in the bin.

    A document longer than a bin fills whole bins with its first pieces, and the rest is
    packed. `cluster` names a document's duplicate cluster, by default that of its words.
    `docs` needs doc_id, text and source; other columns are left aside. Documents without
    words (null, empty) are one piece of length 0 in no bin; a null source is a source;
    repeated rows are copies and go to different bins; pieces of one length go by id; no
    rows give no rows. The result depends on the rows alone, not on their partitions.
    """
    python_ready(docs.sparkSession)
    n = F.size(words(F.col("text")))
    known = (cluster if cluster is not None else text_cluster(F.col("text"))).alias("cluster")
    rows = docs.select("doc_id", "source", n.cast("long").alias("n"), known)
    # Rows that are alike in all of this are counted and numbered, which deals them to shards by what they hold alone.
    alike = rows.groupBy("doc_id", "source", "n", "cluster").agg(F.count(F.lit(1)).alias("copies"))
    rows = alike.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    rows = rows.withColumn("key", F.xxhash64("doc_id", "source", "n", "cluster", "copy"))
    piece = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0)).cast("int")))
    start = F.col("piece") * F.lit(capacity).cast("long")
    cut = rows.withColumn("piece", piece).withColumn("start", start).withColumn("length", F.least(F.col("n") - start, F.lit(capacity).cast("long")))
    pieces = stored(cut, "packing-pieces")
    shards = max(1, -(-stored_count(pieces) // SHARD_ROWS))
    dealt = pieces.filter("length > 0").select(
        "doc_id",
        "source",
        "piece",
        "start",
        "length",
        F.pmod(F.xxhash64(F.col("cluster")), F.lit(CLUSTER_BITS)).alias("cluster"),
        F.pmod(F.xxhash64(F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()), F.lit(SOURCE_BITS)).alias("bit"),
        F.pmod(F.xxhash64(F.lit("shard"), "key", "piece"), F.lit(shards)).alias("shard"),
    )
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", F.desc("length"), "doc_id", "piece", "cluster", "source")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, piece int, start long, length long, bin long, position long"
    empty = pieces.filter("length = 0").select("doc_id", "source", "piece", "start", "length", F.lit(None).cast("long").alias("bin"), F.lit(None).cast("long").alias("position"))
    return ordered.mapInArrow(_packer(capacity), schema).union(empty)

"""Removal of repeated word runs over a compacted de Bruijn graph of 20-word edges.

Every 20 consecutive words (a window) are an edge. Writing all edges out would be eight
bytes and a place per word, so edges travel in paths. Each window names its anchor, the
run of five words in it with the least hash, and neighbouring windows with one anchor are
one path: equal windows have equal anchors, so whatever repeats meets at its anchor.

1. Anchors that occur once are on no repeated edge and end there.
2. The paths of the others are grouped by anchor and content. A content's first place (by
   document and position) stays, and every other place of it is a repeat as a whole: the
   nonbranching stretches of the graph, compacted, need no more than that.
3. Where an anchor has several contents the path branches. Only there are paths taken
   apart into edges, one per distinct content, and joined by edge; an edge's first place
   stays again.
4. The places found are source coordinates, and the words at them decide: every candidate
   place, first ones too, gets the digest of its words, read from its text, and places of
   one digest are the repeats of the first of them. Per document the repeats are united
   into spans, and the words under them are removed.

A path's marks, 32 bits an edge beside the anchor's 64, only find candidates: equal words
always have equal marks, and places whose marks agree by chance have other digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored
from leafmill.llm.tokens import python_ready, ranges, run_hashes, text_batches, text_pieces, word_hashes

WINDOW = 20
ANCHOR = 5


def _anchors(hashes: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows and anchor hash of every path; the windows' hashes in the same order."""
    runs, at = run_hashes(hashes, bounds, anchor)
    edges, starts = run_hashes(hashes, bounds, window)
    counts = np.diff(starts)
    place = ranges(np.zeros(len(counts), np.int64), counts)
    text = np.repeat(np.arange(len(counts)), counts)
    best = np.arange(len(runs))
    span, reach = window - anchor + 1, 1
    while reach < span:
        # The rightmost of equal hashes, so that the choice depends on the words alone.
        step = min(reach, span - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(runs[right] <= runs[left], right, left)
        reach += step
    chosen = best[at[text] + place] if len(text) else np.zeros(0, np.int64)
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(chosen)))
    return text[first], place[first], size, runs[chosen[first]], edges


def _paths(with_marks: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            ids, marked = batch.column("doc_id"), batch.column("text_mark")
            for lo, hi in text_pieces(texts):
                text, start, size, anchor, edges = _anchors(*word_hashes(texts[lo:hi]), WINDOW, ANCHOR)
                anchors = pa.array(anchor.view(np.int64))
                if not with_marks:
                    yield pa.RecordBatch.from_arrays([anchors], ["anchor"])
                    continue
                ends = np.concatenate([[0], np.cumsum(4 * size)]).astype(np.int32)
                marks = np.ascontiguousarray((edges >> np.uint64(32)).astype(np.uint32))
                blobs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(marks)])
                row = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [anchors, ids.take(row), marked.take(row), pa.array(start.astype(np.int32)), blobs], ["anchor", "doc_id", "text_mark", "start", "marks"]
                )

    return run


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each path as its edges."""
    for batch in batches:
        blobs = batch.column("marks").to_pylist()
        size = np.fromiter((len(b) // 4 for b in blobs), np.int64, len(blobs))
        row = pa.array(np.repeat(np.arange(len(size)), size))
        marks = np.frombuffer(b"".join(blobs), np.int32)
        at = ranges(batch.column("start").to_numpy().astype(np.int64), size).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("anchor").take(row), pa.array(marks), batch.column("doc_id").take(row), batch.column("text_mark").take(row), pa.array(at)],
            ["anchor", "mark", "doc_id", "text_mark", "start"],
        )


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and `text_mark`, a hash of the text: rows are known by id and text, so that texts of one id are kept apart."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_mark"))


def _candidates(texts: DataFrame) -> DataFrame:
    """doc_id, text_mark, start, size: runs of `size` windows, from word `start` on, whose marks occur more than once; stored."""
    seen = texts.mapInArrow(_paths(False), "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    often = stored(seen.filter("n > 1").select("anchor"), "debruijn-anchors")
    paths = texts.mapInArrow(_paths(True), "anchor long, doc_id long, text_mark long, start int, marks binary")
    paths = stored(paths.join(often, "anchor", "left_semi"), "debruijn-paths")
    place = F.struct("doc_id", "text_mark", "start")
    contents = stored(paths.groupBy("anchor", "marks").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places")), "debruijn-contents")
    again = contents.filter("places > 1").select("anchor", "marks")
    whole = paths.join(again, ["anchor", "marks"]).select("doc_id", "text_mark", "start", (F.octet_length("marks") / 4).cast("int").alias("size"))

    branching = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    split = contents.join(branching, "anchor", "left_semi").select("anchor", "marks", "first.*")
    edges = stored(split.mapInArrow(_edges, "anchor long, mark int, doc_id long, text_mark long, start int"), "debruijn-edges")
    shared = edges.groupBy("anchor", "mark").agg(F.count(F.lit(1)).alias("places")).filter("places > 1").drop("places")
    single = edges.join(shared, ["anchor", "mark"]).select("doc_id", "text_mark", "start", F.lit(1).alias("size"))
    # Repeated rows bring their places once each; one will do.
    return stored(whole.union(single).distinct(), "debruijn-candidates")


def _with_spans(texts: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """The texts with the places found in them. A text has fewer places than words, whatever the corpus."""
    spans = places.groupBy(F.col("doc_id").alias("of"), F.col("text_mark").alias("mark")).agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    return texts.join(spans, F.col("doc_id").eqNullSafe(F.col("of")) & F.col("text_mark").eqNullSafe(F.col("mark")), how).select("doc_id", "text", "text_mark", "spans")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the words of each span, joined by spaces."""
    for batch, texts in text_batches(batches):
        rows, starts, sizes, digests = [], [], [], []
        for row, (text, spans) in enumerate(zip(texts, batch.column("spans").to_pylist(), strict=True)):
            own = text.split()
            joined = memoryview(b" ".join(own))
            at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in own])]).astype(np.int64).tolist()
            for span in spans:
                lo, size = span["start"], span["size"]
                hi = lo + size + WINDOW - 1
                rows.append(row)
                starts.append(lo)
                sizes.append(size)
                digests.append(hashlib.blake2b(joined[at[lo] : at[hi] - 1], digest_size=16).digest())
        row = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(row) for c in ("doc_id", "text_mark")), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())],
            ["doc_id", "text_mark", "start", "size", "words"],
        )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text_mark, start, size: runs of `size` windows, from word `start` on, whose words also start earlier."""
    texts = _texts(docs)
    met = _with_spans(texts, _candidates(texts), "inner")
    found = met.mapInArrow(_digests, "doc_id long, text_mark long, start int, size int, words binary")
    found = stored(found, "debruijn-digests")
    place = F.struct("doc_id", "text_mark", "start")
    # Stored, so that both sides of the join get exchanges of their own, and one that many places share can be split.
    first = stored(found.groupBy("words").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last").drop("last"), "debruijn-firsts")
    again = stored(found.join(first, "words").filter(place != F.col("first")), "debruijn-again")
    # A place in another text of the first one's id is no repeat of it, only of an earlier one in its own text.
    beside = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_mark") != F.col("first.text_mark"))
    columns = ("doc_id", "text_mark", "start", "size")
    others = again.filter(beside)
    own = others.groupBy("words", F.col("doc_id").alias("of"), F.col("text_mark").alias("mark")).agg(F.min("start").alias("least")).withColumnRenamed("words", "same")
    same = (F.col("words") == F.col("same")) & F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_mark") == F.col("mark"))
    later = others.join(own, same).filter("start > least")
    return stored(again.filter(~beside).select(*columns).union(later.select(*columns)), "debruijn-repeats")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        words, removed, digests = [], [], []
        for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
            own = text.split()
            gone = np.zeros(len(own) + 1, np.int64)
            for span in spans or ():
                lo, hi = span["start"], span["start"] + span["size"] + WINDOW - 1
                gone[lo] += 1
                gone[hi] -= 1
            out = np.cumsum(gone)[:-1] > 0
            kept = own if not out.any() else [w for w, x in zip(own, out.tolist(), strict=True) if not x]
            words.append(len(own))
            removed.append(len(own) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the SHA-256 of the kept words joined by spaces.

    A word is removed if a window of 20 words over it also starts earlier: in a document
    with a smaller doc_id, or before it in its own. Windows are judged on the input. Null
    and empty texts have no words; shorter texts than a window lose none; of rows that share
    an id none is earlier than another, whether their texts are equal or not, and each
    text is judged by itself; a null id is smaller than all others; other columns are left
    aside; no rows give no rows.
    """
    python_ready(docs.sparkSession)
    rows = _with_spans(_texts(docs), repeats(docs), "left")
    return rows.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")

"""Word hashes of whole texts with numpy, for operators that run in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from leafmill.session import ship_code

# Bytes of text hashed at once; a batch of longer texts is done piece by piece.
PIECE = 1 << 21
# Texts per Arrow batch, and their bytes.
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 24
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def python_ready(spark: SparkSession) -> None:
    """The package on the workers, and Arrow batches short enough for long texts."""
    ship_code()
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    limit = as_bytes(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each value."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_A
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_B
    return x ^ (x >> np.uint64(31))


def _hashed(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a byte buffer."""
    inside = ~_SPACE[buffer]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    place = np.arange(len(buffer))
    place[starts[0] :] -= np.repeat(starts, np.diff(starts, append=len(buffer)))
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _ODD))
    terms = (buffer.astype(np.uint64) + np.uint64(1)) * powers[np.minimum(place, len(powers) - 1)]
    terms[~inside] = 0
    return mixed(np.add.reduceat(terms, starts) + lengths.astype(np.uint64)), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and where each text's words start (one more entry at the end)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    limits = np.concatenate([[0], np.cumsum(sizes)])
    whole = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    hashes, places, at = [], [], 0
    while at < len(whole):
        end = min(at + PIECE, len(whole))
        while end < len(whole) and not _SPACE[whole[end - 1]]:
            end += 1
        h, s = _hashed(whole[at:end])
        hashes.append(h)
        places.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), limits)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each of the lengths, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def run_hashes(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `n` words that stay in one text, and where each text's runs start.

    A polynomial over the word hashes rolls along by one word; it is mixed at the end.
    """
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    at = ranges(bounds[:-1], counts)
    total = np.zeros(len(at), np.uint64)
    for j in range(n):
        total = total * _ODD + hashes[at + j]
    return mixed(total), np.concatenate([[0], np.cumsum(counts)])


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with its texts as UTF-8 bytes, null as empty."""
    for batch in batches:
        yield batch, [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def text_pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE bytes each: memory is bounded by the longest text, whatever the batch holds."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > PIECE:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)

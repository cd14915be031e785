"""Toxicity by logistic regression over hashed word n-grams and skip-grams, trained with FTRL-proximal.

Per-coordinate learning rates let rare words learn fast, and the L1 term leaves most
coordinates at exactly zero, so what is broadcast for scoring is a few thousand pairs.
Training runs in rounds: each shard of the sample goes on from the common state for one
pass, and the shards' states are averaged. Scores see the text only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.common import stored
from leafmill.llm.tokens import mixed, python_ready, word_hashes

BITS = 19
# Distance of the two words of a pair: neighbours, and pairs that skip one or two words.
GAPS = (1, 2, 3)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 1.0
# What a toxic document weighs beside a clean one.
TOXIC_WEIGHT = 1.5
# The most labelled documents, and bytes of their texts, that are trained on, taken in the order of a hash of their ids.
SAMPLE, SAMPLE_BYTES = 20_000, 1 << 28
SHARDS, ROUNDS = 4, 4
# Parts that a state is averaged in.
PARTS = 32
BIAS = 1 << BITS
# Lower-case letters, digits and everything beyond ASCII stay, the rest parts words.
_KEEP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PIECE_CHARS = 1 << 20


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and coordinate of every unigram and word pair, with repeats."""
    hashes, bounds = word_hashes([(t or "").lower().encode("utf-8", "replace").translate(_KEEP) for t in texts])
    text = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(bounds))
    rows, found = [text], [hashes]
    for gap in GAPS:
        same = text[gap:] == text[:-gap]
        rows.append(text[gap:][same])
        found.append(mixed(hashes[:-gap][same] * np.uint64(2 * gap + 1) + hashes[gap:][same]))
    return np.concatenate(rows), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def pieces(texts: list[str | None]):
    """Ranges of texts with about PIECE_CHARS characters each, so that memory is bounded by the longest text."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > PIECE_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t or "")
    if start < len(texts):
        yield start, len(texts)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that a state stands for; the last coordinate, the bias, is not shrunk to zero."""
    edge = np.full(len(z), L1)
    edge[-1] = 0.0
    return np.where(np.abs(z) <= edge, 0.0, -(z - np.sign(z) * edge) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _pass(z: np.ndarray, n: np.ndarray, texts: list[str | None], labels: np.ndarray) -> None:
    """One pass over the texts, which changes the state in place."""
    for start, end in pieces(texts):
        rows, found = features(texts[start:end])
        order = np.unique((rows << (BITS + 1)) | found)
        rows, found = order >> (BITS + 1), order & (BIAS - 1)
        bounds = np.searchsorted(rows, np.arange(end - start + 1))
        for i in range(end - start):
            at = np.append(found[bounds[i] : bounds[i + 1]], BIAS)
            y = labels[start + i]
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - y) * (TOXIC_WEIGHT if y else 1.0)
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA * w
            n[at] = ns + g * g


def _shard_pass(state, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = (x.astype(np.float64) for x in state.value)
        order = mixed(rows["doc_id"].to_numpy(np.int64).astype(np.uint64) + np.uint64(turn))
        rows = rows.assign(order=order).sort_values(["order", "doc_id", "text"], na_position="first")
        _pass(z, n, rows["text"].tolist(), rows["toxic"].to_numpy())
        parts = [[x.tobytes() for x in np.array_split(v.astype(np.float32), PARTS)] for v in (z, n)]
        return pd.DataFrame({"part": range(PARTS), "shard": rows["shard"].iloc[0], "z": parts[0], "n": parts[1]})

    return run


def _averaged(rows: pd.DataFrame) -> pd.DataFrame:
    """The mean of the shards' states in one part of the coordinates."""
    rows = rows.sort_values("shard")
    mean = {k: [np.mean([np.frombuffer(x, np.float32) for x in rows[k]], axis=0).tobytes()] for k in ("z", "n")}
    return pd.DataFrame({"part": [rows["part"].iloc[0]], **mean})


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; one without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """doc_id, text, toxic and shard of at most `rows` labelled documents that are not held out, and of at most SAMPLE_BYTES of text.

    The sample of ids is bounded, so it may be broadcast, and texts are not shuffled for
    the join. Of an id's texts the least is taken. Documents are counted
    in the order of a hash of their ids until their texts exceed the bytes.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one_text = stored(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-texts")
    # One task's window over at most `rows` ids and lengths.
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    within = one_text.select("doc_id", size.alias("held")).filter(F.col("held") <= SAMPLE_BYTES).select("doc_id")
    found = one_text.join(F.broadcast(within), "doc_id")
    return found.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(SHARDS)))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights that are not zero. Without any labelled document the bias is minus infinity."""
    spark = docs.sparkSession
    python_ready(spark)
    data = stored(sample(docs, labels, rows), "toxicity-sample")
    z, n = np.zeros(BIAS + 1, np.float32), np.zeros(BIAS + 1, np.float32)
    for turn in range(rounds):
        state = spark.sparkContext.broadcast((z, n))

        passed = data.groupBy("shard").applyInPandas(_shard_pass(state, turn), "part int, shard long, z binary, n binary")
        # One state comes back, its size fixed by BITS.
        made = passed.groupBy("part").applyInPandas(_averaged, "part int, z binary, n binary").collect()
        state.destroy()
        if not made:
            return np.array([BIAS]), np.array([-np.inf])
        made.sort(key=lambda r: r["part"])
        z, n = (np.concatenate([np.frombuffer(r[k], np.float32) for r in made]) for k in ("z", "n"))
        del made
    found = weights(z.astype(np.float64), n.astype(np.float64))
    return np.flatnonzero(found), found[found != 0]


def scorer(spark: SparkSession, model: tuple[np.ndarray, np.ndarray]) -> Callable[[Column], Column]:
    """A column function from text to its score: 0 to 1, null and empty texts have the bias alone."""
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)

    def scores(texts: pd.Series) -> pd.Series:
        at, values = shared.value
        dense = np.zeros(BIAS + 1)
        dense[at] = values
        bias, dense = dense[BIAS], dense[:BIAS]
        used = dense != 0
        out = []
        whole = texts.tolist()
        for start, end in pieces(whole):
            rows, found = features(whole[start:end])
            hit = used[found]
            once = np.unique((rows[hit] << (BITS + 1)) | found[hit])
            total = np.bincount(once >> (BITS + 1), dense[once & (BIAS - 1)], end - start) + bias
            with np.errstate(over="ignore"):
                out.append(1 / (1 + np.exp(-total)))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return F.pandas_udf(scores, "double")


def scored(docs: DataFrame, labels: DataFrame, **sizes: int) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5 on) for every document.

    `docs` needs doc_id and text, `labels` doc_id and toxic; other columns are left
    aside. Null and empty texts get the bias's score; labels that are null, or of
    documents not there, teach nothing; of several labels of a document the larger
    counts; repeated rows are scored row by row; without labels all scores are 0; no
    rows give no rows.
    """
    score = scorer(docs.sparkSession, train(docs, labels, **sizes))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, **sizes: int) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns.

    Nulls, repeats and missing labels are as in `scored`: null and empty texts have the
    bias's score, and without labels every document stays. Further columns pass through
    whatever their names; no rows give no rows.
    """
    score = scorer(docs.sparkSession, train(docs, labels, **sizes))
    return docs.filter(score(F.col("text")) < 0.5)

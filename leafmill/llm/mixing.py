"""Mixing sources to target weights: a temperature found by bisection, realised as budgeted block permutations.

Everything is DataFrame functions. Sources' weights are their token shares to the power
of an exponent, normalised. A weight times the budget is a source's quota, which is
filled by whole passes over the source and a part of one more, up to the document that
reaches the quota, each pass in an order of its own. Running totals are taken in two steps, over small buckets of the order and
inside them, so that a source with most of the rows is no single task's work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.common import stored, words

# Sections per round and rounds: each round narrows the exponent by four bits.
SECTIONS, STEPS = 16, 6
# What a quota may be short of a whole token by, as a share of itself: some last digits of a double.
TOLERANCE = 1e-14
# Documents per bucket of an order, about.
BUCKET_ROWS = 4096


@dataclass(frozen=True)
class Mix:
    """What a mix has to meet. `entropy` is a share of the entropy of equal weights; `budget` a multiple of all tokens."""

    entropy: float = 0.9
    repetition: float = 4.0
    budget: float = 1.0
    block_tokens: int = 1 << 17
    seed: int = 1


def token_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, tokens (words; a document without any counts as one) and `key`, a hash of id and text, stored."""
    key = F.xxhash64("doc_id", "text")
    tokens = F.greatest(F.size(words(F.col("text"))), F.lit(1)).cast("long")
    return stored(docs.select("doc_id", "source", tokens.alias("tokens"), key.alias("key")), "mixing-tokens")


def exponent(shares: DataFrame, mix: Mix) -> float:
    """The largest exponent in 0 .. 1 that meets the entropy, raised where that would break the repetition limit.

    Entropy falls and repetition falls as the exponent rises, so both bounds are found by
    bisection, four halvings per job; a job brings one row per tried exponent.
    """

    def tried(low: float, high: float) -> list:
        at = F.array(*(F.lit(low + (high - low) * i / SECTIONS) for i in range(SECTIONS + 1)))
        power = F.exp(F.col("t") * F.col("log"))
        sums = shares.select("log", F.explode(at).alias("t")).groupBy("t").agg(
            F.sum(power).alias("z"), F.sum(power * F.col("log")).alias("zl"), F.max(F.exp((F.col("t") - 1) * F.col("log"))).alias("most"), F.count(F.lit(1)).alias("n")
        )
        h = F.log("z") - F.col("t") * F.col("zl") / F.col("z")
        return sums.select("t", (h >= mix.entropy * F.log("n") - 1e-9).alias("even"), (F.col("most") / F.col("z") * mix.budget <= mix.repetition + 1e-9).alias("fresh")).orderBy("t").collect()

    def bisected(holds, low_side: bool) -> float:
        """The border between exponents that hold and that do not; `low_side`: the small ones hold."""
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            rows = tried(low, high)
            ok = [r["t"] for r in rows if holds(r)]
            if len(ok) == len(rows):
                return rows[-1]["t"] if low_side else rows[0]["t"]
            if not ok:
                return rows[0]["t"] if low_side else rows[-1]["t"]
            step = (high - low) / SECTIONS
            low, high = (max(ok), max(ok) + step) if low_side else (min(ok) - step, min(ok))
        return low if low_side else high

    if shares.isEmpty():
        return 1.0
    even = bisected(lambda r: r["even"], True)
    return round(max(even, bisected(lambda r: r["fresh"], False)), 6)


def quotas(counts: DataFrame, mix: Mix) -> DataFrame:
    """Per source: its tokens, weight and quota, stored. At exponent 1 each source gets its own share of the budget."""
    sources = stored(counts.groupBy("source").agg(F.sum("tokens").alias("source_tokens")), "mixing-sources")
    total = sources.agg(F.sum("source_tokens")).first()[0] or 0
    shares = sources.withColumn("log", F.log(F.col("source_tokens") / total)) if total else sources.withColumn("log", F.lit(0.0))
    t = exponent(shares, mix)
    raised = shares.withColumn("power", F.exp(t * F.col("log")))
    z = raised.agg(F.sum("power")).first()[0] or 1.0
    weight = F.col("power") / z
    # Shares are whole numbers of tokens, which no power and no sum need to be taken of.
    meant = F.col("source_tokens") * mix.budget if t == 1 else weight * (mix.budget * total)
    quota = F.floor(meant * (1 + TOLERANCE) + 1e-6).cast("long")
    return stored(raised.select(F.col("source").alias("of"), "source_tokens", F.round(weight, 12).alias("weight"), quota.alias("quota")), "mixing-quotas")


def _order(key: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch, key)


def schedule(counts: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, key, source, tokens, weight, epoch, order, start: every use of a document, `start` tokens into its source's stream."""
    rows = counts.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    passes = F.floor(F.col("quota") / F.col("source_tokens")).cast("int")
    uses = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), passes))).withColumn("order", _order(F.col("key"), F.col("epoch"), mix.seed))
    bits = max(0, (counts.groupBy().count().first()[0] // BUCKET_ROWS).bit_length())
    uses = uses.withColumn("bucket", F.shiftright(F.col("order"), 64 - bits) if bits else F.lit(0).cast("long"))
    sums = uses.groupBy("source", "epoch", "bucket").agg(F.sum("tokens").alias("held"))
    before = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("bucket").alias("b"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset")
    )
    placed = uses.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("bucket") == F.col("b"))).drop("s", "e", "b")
    inside = Window.partitionBy("source", "epoch", "bucket").orderBy("order", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("epoch") * F.col("source_tokens") + F.col("offset") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return placed.withColumn("start", start).filter(F.col("start") < F.col("quota")).drop("bucket", "offset")


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per use of a document: doc_id, source, n_tokens, weight, epoch, block, slot.

    Every source's stream is cut evenly over the blocks, so each block holds the sources
    at their weights; `slot` is the place in the block's own permutation. Uses end with
    the document that reaches the source's quota, which is used whole: a source with any
    quota has a document in the mix, however long its documents are, and exceeds the quota
    by less than one document.

    `docs` needs doc_id, text and source; other columns are left aside. A null source is a
    source; texts without words count as one token, so that they too are placed; repeated
    rows are used row by row; equal rows tie in any order, which the result does not
    show; one source has weight 1; no rows give no rows.
    """
    counts = token_counts(docs)
    plan = quotas(counts, mix)
    uses = schedule(counts, plan, mix)
    blocks = plan.agg(F.sum("quota")).first()[0] or 0
    blocks = max(1, -(-blocks // mix.block_tokens))
    block = F.floor(F.col("start") * F.lit(float(blocks)) / F.greatest(F.col("quota"), F.lit(1))).cast("long")
    placed = uses.withColumn("block", F.least(block, F.lit(blocks - 1)))
    slot = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(mix.seed), "block", "epoch", "key"), "doc_id", "epoch")
    return placed.select("doc_id", "source", F.col("tokens").alias("n_tokens"), "weight", "epoch", "block", F.row_number().over(slot).cast("long").alias("slot"))


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents as often as the mix uses them, with all their columns.

    A pass over a source is used up to some place of its order, so the last hash used in
    each source's last pass says which documents are in; texts meet only that small,
    stored table. Documents without words count as one token and stay; a null source is a
    source; equal rows are used alike, also those at the end of the last pass; further
    columns pass through whatever their names; no rows give no rows.
    """
    counts = token_counts(docs)
    plan = quotas(counts, mix)
    last = F.floor(F.col("quota") / F.col("source_tokens")).cast("int")
    ends = schedule(counts, plan, mix).filter(F.col("epoch") == last).groupBy("source").agg(F.max("order").alias("cut"))
    cuts = stored(
        plan.join(ends, F.col("of").eqNullSafe(F.col("source")), "left").select("of", last.alias("passes"), "cut"), "mixing-cuts"
    )
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    met = rows.join(cuts, F.col("row.source").eqNullSafe(F.col("of")))
    key = F.xxhash64("row.doc_id", "row.text")
    partly = F.coalesce((_order(key, F.col("passes"), mix.seed) <= F.col("cut")).cast("int"), F.lit(0))
    uses = met.select("row", (F.col("passes") + partly).alias("uses")).filter("uses > 0")
    return uses.select("row", F.explode(F.sequence(F.lit(1), F.col("uses")))).select("row.*")

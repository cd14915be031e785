"""Quality rules per document, and verdicts on whole hosts from the rates at which their documents fail.

Everything is DataFrame functions. A text is measured inside its row, so texts are
never shuffled; hosts see counts only, summed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.markup import let
from leafmill.llm.common import SPACES, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
# A host whose shrunk failure rate under some rule is above this loses all its documents.
MAX_HOST_RATE = 0.5
# Prior strength, in documents, where hosts do not differ beyond chance.
MAX_STRENGTH = 1e6
RULES = ("few_words", "repeats", "symbols", "dup_lines")


def repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window that is found at least twice in the text, first occurrence included.

    Windows are compared by the 64-bit hash of their words' hashes. A text without a
    repeat is settled by one hash set; else windows are sorted by (hash, place), equal
    neighbours are repeats, and one pass over their places adds up what they cover.
    """

    def hashes(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - window)
        grams = F.transform(at, lambda i: F.xxhash64(*(w[i + j] for j in range(window))))
        return F.when(F.size(w) >= window, grams).otherwise(F.array().cast("array<bigint>"))

    def step(done: Column, place: Column) -> Column:
        end = place + window
        return F.struct((done["total"] + end - F.greatest(place, done["end"])).alias("total"), end.alias("end"))

    def places(s: Column) -> Column:
        same = F.filter(s, lambda e, j: (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]))
        return F.sort_array(F.transform(same, lambda e: e["i"]))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
        total = F.aggregate(let(ordered, places), start, step, lambda done: done["total"])
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(total)

    return let(let(F.transform(tokens, lambda x: F.xxhash64(x)), hashes), covered).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source, the counts of each text, and one boolean per rule."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.char_length(F.translate(text, SPACES, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    counted = docs.select(
        "doc_id",
        "source",
        bare.cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("repeat"))).alias("words"),
    )
    flat = counted.select(
        "doc_id",
        "source",
        F.col("words")["n"].alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("lines")["dup"].alias("n_dup_lines"),
        F.col("words")["repeat"].alias("n_repeat_words"),
        F.col("lines")["all"].alias("n_lines"),
    )
    return flat.select(
        "*",
        (F.col("n_words") < MIN_WORDS).alias("few_words"),
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")).alias("repeats"),
        (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")).alias("symbols"),
        (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")).alias("dup_lines"),
    )


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host and rule: documents, failures, and the failure rate shrunk towards all hosts' rates.

    The prior is a beta distribution fitted by moments to the hosts' rates: their mean,
    and their variance less what drawing so few documents explains. Its strength s turns
    a host's k failures of n into (k + s * mean) / (n + s).
    """
    fails = F.array(*(F.struct(F.lit(r).alias("rule"), F.sum(F.col(r).cast("long")).alias("k")) for r in RULES))
    hosts = measured.groupBy("source").agg(F.count(F.lit(1)).alias("n"), fails.alias("fails"))
    rates = hosts.select("source", "n", F.inline("fails"))
    rate = F.col("k") / F.col("n")
    prior = rates.groupBy("rule").agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("var"), F.avg(1 / F.col("n")).alias("inv"))
    spread = F.col("mean") * (1 - F.col("mean"))
    between = F.greatest(F.col("var") - spread * F.col("inv"), F.lit(0.0))
    strength = F.when(between * MAX_STRENGTH > spread, F.greatest(spread / between - 1, F.lit(0.0))).otherwise(MAX_STRENGTH)
    fitted = prior.select("rule", "mean", strength.alias("strength"))
    shrunk = (F.col("k") + F.col("strength") * F.col("mean")) / (F.col("n") + F.col("strength"))
    return rates.join(fitted, "rule").select("source", "rule", "n", "k", shrunk.alias("rate"))


def judged(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: its counts, `base_failed`, `host_failed` and `kept`.

    `docs` needs doc_id, text and source; other columns are left aside. Null and empty
    texts have no words and fail the base rules; a null source is a host of its own;
    repeated rows are judged and counted row by row; no rows give no rows.
    """
    measured = stored(measures(docs), "quality-measures")
    failed = F.max(F.col("rate") > max_host_rate)
    hosts = host_rates(measured).groupBy(F.col("source").alias("host")).agg(failed.alias("host_failed"))
    base = F.col("few_words") | F.col("repeats")
    return measured.join(hosts, F.col("source").eqNullSafe(F.col("host"))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~F.col("host_failed")).alias("kept"),
        "host_failed",
    )

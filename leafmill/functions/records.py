"""Reading record JSON: one parse per row, with the default a missing field stands for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Record fields that are not text.
_KINDS = {"images": "array<string>", "tags": "array<string>", "reserve_not_met": "boolean"}


def _default(name: str) -> Column:
    kind = _KINDS.get(name, "string")
    if kind == "string":
        return F.lit("")
    return F.lit(False) if kind == "boolean" else F.array().cast(kind)


def canonical_json(fields: Column) -> Column:
    """The same record always gives the same text: keys sorted, spacing dropped."""
    return F.to_json(F.parse_json(fields))


def content_key(fields: Column) -> Column:
    """64-bit key of a record's content, whatever the key order of its JSON."""
    return F.xxhash64(canonical_json(fields))


def read_records(
    parsed: DataFrame, spider: str, names: Iterable[str], record_type: str | None = None
) -> DataFrame:
    """A spider's records with the named JSON fields as columns beside the envelope columns.

    The envelope's own `record_type` is used where the table has it, so that the
    filter reaches the scan; plain envelopes have it read from the JSON.
    """
    names = list(names)
    rows = parsed.filter(F.col("spider") == spider)
    typed = "record_type" in parsed.columns
    if typed and record_type is not None:
        rows = rows.filter(F.col("record_type") == record_type)
    schema = ", ".join(f"`{n}` {_KINDS.get(n, 'string')}" for n in ["type", *names])
    rows = rows.withColumn("_r", F.from_json("fields", schema))
    if not typed:
        rows = rows.withColumn("record_type", F.coalesce(F.col("_r")["type"], F.lit("")))
        if record_type is not None:
            rows = rows.filter(F.col("record_type") == record_type)
    return rows.select(
        "spider",
        "parsed_at",
        "source_fetched_at",
        "record_type",
        *(F.coalesce(F.col("_r")[n], _default(n)).alias(n) for n in names),
    )


def latest(value: str, when: Column | None = None) -> Column:
    """Aggregate: the newest value among rows meeting `when`.

    Newest is parsed last; of one parse run, whose rows share its time, fetched last; of
    one fetch the larger value. A plain max over the three, so map-side aggregation cuts
    every key to one row per task.
    """
    stamped = F.struct("parsed_at", "source_fetched_at", value)
    return F.max(F.when(when, stamped) if when is not None else stamped)[value]


def latest_filled(value: str) -> Column:
    """Aggregate: newest non-blank value, or the field's default when there is none."""
    column = F.col(value)
    filled = F.size(column) > 0 if value in ("images", "tags") else column != ""
    return F.coalesce(latest(value, filled), _default(value))


def sticky_status(final: str = "completed", when: Column | None = None) -> Column:
    """Aggregate: `final` once it was ever seen, else the newest status."""
    seen = F.col("status") == final
    ever = F.bool_or(seen & when if when is not None else seen)
    return F.when(ever, F.lit(final)).otherwise(latest("status", when))

"""Table and record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

STR, TS = T.StringType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# A captured page as a crawler hands it over.
RAW_PAGE = _struct(
    fetched_at=TS,
    spider=STR,
    url=STR,
    http_status=T.IntegerType(),
    headers=T.MapType(STR, STR),
    body=STR,
    payload=STR,
)

# The landed table adds what later jobs would otherwise have to read bodies for.
RAW_TABLE = T.StructType(
    RAW_PAGE.fields
    + [
        T.StructField("has_marker", T.BooleanType()),
        T.StructField("body_bytes", T.IntegerType()),
        T.StructField("fetch_month", T.DateType()),
    ]
)

# One line of a JSONL page export; everything is read as text and coerced afterwards.
JSONL_PAGE = _struct(
    fetched_at=STR,
    spider=STR,
    url=STR,
    http_status=STR,
    headers=T.MapType(STR, STR),
    body=STR,
    payload=STR,
)

# Extracted records; `fields` is canonical JSON and `record_type` its `type`, kept apart for pushdown.
PARSED_TABLE = _struct(
    spider=STR,
    url=STR,
    source_fetched_at=TS,
    parsed_at=TS,
    fields=STR,
    dedup_key=T.LongType(),
    record_type=STR,
    source_month=T.DateType(),
)

# Pages that could not be split: one row per attempt.
ERROR_TABLE = _struct(spider=STR, url=STR, source_fetched_at=TS, parsed_at=TS, error=STR, source_month=T.DateType())

PROGRESS_TABLE = _struct(spider=STR, watermark=TS, updated_at=TS)

# One row per batch of an extraction: what it read and wrote, and how far it came.
BATCH_TABLE = _struct(
    spider=STR, run=STR, batch=T.LongType(), pages=T.LongType(), records=T.LongType(), watermark=TS, finished_at=TS
)

"""Requests without repeats as a stream: a canonical URL passes once until the watermark has left its first request behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.functions.urls import canonical_url

# How long a request hides its repeats, and how late one may come.
WITHIN = "1 day"


def unique_stream(requests: DataFrame, url: str = "url", time: str = "requested_at", within: str = WITHIN) -> DataFrame:
    """The requests of a stream whose canonical URL was not asked for `within` that time before, with `canonical_url`.

    State is one URL per request of that time, dealt by URL, so that it grows with the
    rate of requests and not with the stream.
    """
    named = requests.withColumn("canonical_url", canonical_url(F.col(url)))
    return named.withWatermark(time, within).dropDuplicatesWithinWatermark(["canonical_url"])


def start_requests(requests: DataFrame, path: str, checkpoint: str, url: str = "url", time: str = "requested_at", within: str = WITHIN) -> StreamingQuery:
    """Append what passes to the table at `path`, each batch once, and stop when all that is there was read."""
    unique = unique_stream(requests, url, time, within)
    sink = unique.writeStream.format("parquet").option("path", path).outputMode("append")
    return sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

from datetime import datetime

from pyspark.sql import functions as F

from leafmill.operators import extract
from leafmill.schemas import RAW_PAGE


def ts(text):
    return datetime.fromisoformat(text)


def times(frame, *names):
    """Time columns as text, so that no comparison depends on the machine's zone."""
    for name in names:
        frame = frame.withColumn(name, F.col(name).cast("string"))
    return frame


def scalar(spark, column, **values):
    """One expression over one row."""
    row = spark.range(1)
    for name, value in values.items():
        row = row.withColumn(name, F.lit(value))
    return row.select(column.alias("x")).first()["x"]


def pages_of(spark, pages):
    return spark.createDataFrame(pages, "url string, body string")


def records_of(spark, site, body, url):
    found = extract.explode_records(pages_of(spark, [(url, body)]), site)
    return [r["record"].asDict() for r in found.collect()]


def raw_rows(spark, rows):
    """Raw rows from (time text, spider, url, status, body)."""
    plain = [(t, s, u, c, b) for t, s, u, c, b in rows]
    frame = spark.createDataFrame(plain, "t string, spider string, url string, http_status int, body string")
    full = frame.select(
        F.col("t").cast("timestamp").alias("fetched_at"),
        "spider",
        "url",
        "http_status",
        F.create_map().cast("map<string,string>").alias("headers"),
        "body",
        F.lit("{}").alias("payload"),
    )
    return full.select(*RAW_PAGE.names)

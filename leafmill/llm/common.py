"""What several operators share: words, rows stored in the shared folder, the columns an operator reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.session import scratch_path

# The characters between words.
SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The maximal runs of characters other than space, tab and line ends; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE_RUN), "")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: their lineage ends there, and no lost executor matters."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stored_count(rows: DataFrame) -> int:
    """The number of rows of a stored table, from its files' footers."""
    return rows.groupBy().count().first()[0]

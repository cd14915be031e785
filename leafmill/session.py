"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Page bodies are tens of KB, so Arrow batches are kept short.
ARROW_ROWS = 500

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "leafmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this package's defaults; `master` is left to the cluster unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=8)
def _shipped(application: str) -> None:
    here = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="leafmill-code-")) / "leafmill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in here.rglob("*.py"):
            out.write(source, Path(here.name) / source.relative_to(here))
    SparkSession.getActiveSession().sparkContext.addPyFile(str(archive))


def ship_code() -> None:
    """Let Spark hand this package to its Python workers, once per application, wherever they run."""
    _shipped(SparkSession.getActiveSession().sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster shares, `spark.checkpoint.dir`.

    Without that setting a local session gets a temporary folder; a cluster is refused,
    since its executors would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="leafmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scratch_table(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: steps that repeat go on from files, not from a growing plan."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

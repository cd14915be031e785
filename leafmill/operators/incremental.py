"""Reading raw pages from a watermark on, as batches."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import utc_literal
from leafmill.operators.extract import parse_or_error, parse_pages
from leafmill.operators.landing import month_of
from leafmill.session import scratch_path
from leafmill.sites.base import SitePack
from leafmill.sources.tables import append_batches, append_errors, append_parsed, append_progress, delete_folder, read_parsed, read_progress, read_raw

EPOCH = "1970-01-01 00:00:00"
# Pages, and steps, that one job of a drain in steps takes together; a longer step is a job of its own.
JOB_ROWS, JOB_STEPS = 1 << 20, 1 << 12


def watermark(progress: DataFrame, spider: str) -> DataFrame:
    """One row with the watermark written last for a spider, the epoch when there is none."""
    newest = F.max(F.struct("updated_at", "watermark"))["watermark"]
    mine = progress.filter(F.col("spider") == spider)
    return mine.agg(F.coalesce(newest, F.lit(EPOCH).cast("timestamp")).alias("watermark"))


def _as_time(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def raw_after(raw: DataFrame, spider: str, after: Column, until: Column | None = None) -> DataFrame:
    """A spider's pages fetched after a time, up to another, other months pruned, columns cut to what extraction reads."""
    rows = raw.filter((F.col("spider") == spider) & (F.col("fetched_at") > after))
    if until is not None:
        rows = rows.filter(F.col("fetched_at") <= until)
    if "fetch_month" in raw.columns:
        rows = rows.filter(F.col("fetch_month") >= month_of(after))
        if until is not None:
            rows = rows.filter(F.col("fetch_month") <= month_of(until))
    return rows.select("spider", "url", "body", "fetched_at")


def _places(raw: DataFrame, spider: str, after: Column) -> DataFrame:
    """Time and URL of the pages after a time, without their bodies."""
    return raw_after(raw.withColumn("body", F.lit(None)), spider, after).select("fetched_at", "url")


def batch_end(raw: DataFrame, spider: str, after: Column, rows: int | None) -> DataFrame:
    """One row with the time `until` of the last of the oldest `rows` pages after a time (of all of them for None)."""
    times = _places(raw, spider, after).select("fetched_at")
    oldest = times if rows is None else times.orderBy("fetched_at").limit(rows)
    return oldest.agg(F.max("fetched_at").alias("until"))


def step_ends(raw: DataFrame, spider: str, after: Column, rows: int, steps: int) -> DataFrame:
    """One row with the times `ends` of the last pages of up to `steps` steps in a row, each as `batch_end` would cut it after the one before.

    A step that is not full is there only where no page follows it.
    """
    times = _places(raw, spider, after).select("fetched_at").orderBy("fetched_at").limit(rows * steps)
    none = F.array().cast("array<timestamp>")
    start = F.struct(none.alias("ends"), F.lit(0).alias("n"), F.lit(None).cast("timestamp").alias("last"))

    def step(done: Column, time: Column) -> Column:
        # Full, and the next page is not as old as the last one.
        cut = (done["n"] >= rows) & (time > done["last"])
        return F.struct(
            F.when(cut, F.concat(done["ends"], F.array(done["last"]))).otherwise(done["ends"]).alias("ends"),
            F.when(cut, F.lit(1)).otherwise(done["n"] + 1).alias("n"),
            time.alias("last"),
        )

    def finish(done: Column) -> Column:
        whole = (done["n"] >= rows) | ((F.size("times") < rows * steps) & (done["n"] > 0))
        return F.when(whole, F.concat(done["ends"], F.array(done["last"]))).otherwise(done["ends"])

    listed = times.agg(F.sort_array(F.collect_list("fetched_at")).alias("times"))
    return listed.select(F.aggregate("times", start, step, finish).alias("ends"))


def _step_of(time: Column, ends: Column, steps: int) -> Column:
    """How many of the ascending `ends` lie before a time, by bisection."""
    halves = F.array(*(F.lit(1 << bit) for bit in reversed(range(steps.bit_length()))))
    return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(ends, at + half - 1) < time, at + half).otherwise(at))


def next_batch(raw: DataFrame, spider: str, after: Column, rows: int) -> DataFrame:
    """The oldest `rows` pages after a time, and with them all pages as old as the last one.

    The next batch starts strictly after that time, so none is lost. The cut is found on
    the time column alone: bodies are read once and never sorted whole.
    """
    return raw_after(raw, spider, after, batch_end(raw, spider, after, rows).scalar())


def next_exact(raw: DataFrame, spider: str, after: Column, after_url: Column | None, rows: int) -> DataFrame:
    """The oldest `rows` pages after a place, in order of (time, URL).

    The next call goes on from the last row's time and URL, so pages that tie in time are
    not lost; only rows alike in both come together. Without `after_url` the place is
    after all pages of that time.
    """
    if after_url is None:
        later = raw_after(raw, spider, after)
        narrow = _places(raw, spider, after)
    else:
        # A moment earlier, so that the pages of the time itself are seen; times have microseconds.
        before = after - F.expr("INTERVAL '0.000001' SECOND")
        beyond = (F.col("fetched_at") > after) | (F.col("url") > after_url)
        later = raw_after(raw, spider, before).filter(beyond)
        narrow = _places(raw, spider, before).filter(beyond)
    place = F.struct("fetched_at", "url")
    last = narrow.orderBy("fetched_at", "url").limit(rows).agg(F.max(place).alias("last"))
    return later.filter(place <= last.scalar())


def replay(raw: DataFrame, spider: str, since: datetime | None = None) -> DataFrame:
    """Every page after `since` (UTC if it has no offset), or all of them, whatever the progress table says."""
    return raw_after(raw, spider, utc_literal(since) if since else _as_time(EPOCH))


def extract_batch(
    pages: DataFrame,
    parsed_path: str,
    pack: SitePack,
    label: str | None = None,
    errors_path: str | None = None,
    now: datetime | None = None,
) -> tuple[int, int, str | None]:
    """Append the records of the pages; returns pages read, records written and the newest fetch time.

    All three are observed while the records are written, so nothing is read for them.
    Work that is done again after an executor was lost may count again. `label` is that
    of `append_parsed`, `now` the time that records are stamped with. A page that cannot be split fails the batch, or with `errors_path`
    costs a row in the table there: records and reasons are then written aside in one pass
    over the bodies, and dealt to their tables from it.
    """
    spark, aside = pages.sparkSession, None
    stamp = utc_literal(now or datetime.now(timezone.utc))
    read, written = Observation(), Observation()
    seen = pages.observe(read, F.count(F.lit(1)).alias("pages"), F.max("fetched_at").cast("string").alias("newest"))
    if errors_path is None:
        rows = parse_pages(seen, pack, stamp)
    else:
        aside, told = scratch_path(spark, "extracted"), parse_or_error(seen, pack, stamp)
        told.write.parquet(aside)
        told = spark.read.schema(told.schema).parquet(aside)
        append_errors(told.filter(F.col("error").isNotNull()), errors_path, label)
        rows = told.filter(F.col("error").isNull()).drop("error")
    append_parsed(rows.observe(written, F.count(F.lit(1)).alias("records")), parsed_path, label)
    if aside is not None:
        delete_folder(spark, aside)
    records = written.get["records"] if _noted(written) else 0
    if _noted(read):
        return read.get["pages"], records, read.get["newest"]
    # Without any row adaptive execution drops the plan and what it observed; the pages are few or bear nothing.
    pages_read, newest = pages.agg(F.count(F.lit(1)), F.max("fetched_at").cast("string")).first()
    return pages_read, records, newest


def _noted(observation: Observation) -> bool:
    """Whether the plan that was observed was still there when the job ended."""
    return observation._jo.getRow().length() > 0


def drain(
    spark: SparkSession,
    raw_path: str,
    parsed_path: str,
    progress_path: str,
    pack: SitePack,
    *,
    batch_rows: int | None = None,
    reset: bool = False,
    since: datetime | None = None,
    batches_path: str | None = None,
    errors_path: str | None = None,
) -> dict[str, int]:
    """Extract everything new, then move the watermark; returns pages and records handled.

    One distributed job by default; `batch_rows` works through it in steps instead. Steps
    are cut ahead, and as many as come to JOB_ROWS pages are extracted by one job, which
    reads their months only: a step costs its rows, not a job. The records are written
    before the watermark, so a run that dies is repeated from the last job on, and
    `latest_versions` folds the repeats. `since` wins over `reset`. `batches_path` names a
    table that gets a row per step, `errors_path` one for pages that cannot be split,
    which fail the run otherwise.
    """
    if since is not None or reset:
        after = utc_literal(since) if since is not None else _as_time(EPOCH)
    else:
        marked = watermark(read_progress(spark, progress_path), pack.name)
        after = _as_time(marked.select(F.col("watermark").cast("string")).first()[0])
    totals, run, batch = {"pages": 0, "records": 0}, uuid.uuid4().hex, 0
    ahead = max(1, min(JOB_STEPS, JOB_ROWS // batch_rows)) if batch_rows is not None else 1
    while True:
        raw = read_raw(spark, raw_path)
        # Fixed upper bounds: pages landing while the job runs wait for the next one.
        if ahead > 1:
            ends = step_ends(raw, pack.name, after, batch_rows, ahead).select(F.col("ends").cast("array<string>")).first()[0]
        else:
            last = batch_end(raw, pack.name, after, batch_rows).select(F.col("until").cast("string")).first()[0]
            ends = [] if last is None else [last]
        if not ends:
            return totals
        until, now = _as_time(ends[-1]), datetime.now(timezone.utc)
        mine = raw_after(raw, pack.name, after, until)
        pages, records, _ = extract_batch(mine, parsed_path, pack, errors_path=errors_path, now=now)
        append_progress(spark, progress_path, pack.name, *ends)
        if batches_path is not None:
            if len(ends) > 1:
                counted = _counted_steps(mine, _written(spark, parsed_path, pack, now, after, until), ends)
            else:
                counted = spark.createDataFrame([(0, pages, records, ends[0])], _COUNTED)
            append_batches(counted.withColumn("batch", F.col("batch") + batch), batches_path, pack.name, run)
        totals["pages"] += pages
        totals["records"] += records
        after, batch = until, batch + len(ends)
        if batch_rows is None:
            return totals


_COUNTED = "batch long, pages long, records long, watermark string"


def _written(spark: SparkSession, parsed_path: str, pack: SitePack, now: datetime, after: Column, until: Column) -> DataFrame:
    """The records that the job stamped `now` wrote, without their fields."""
    month = F.col("source_month")
    rows = read_parsed(spark, parsed_path).filter((month >= month_of(after)) & (month <= month_of(until)))
    return rows.filter((F.col("parsed_at") == utc_literal(now)) & (F.col("spider") == pack.name)).select("source_fetched_at")


def _counted_steps(pages: DataFrame, records: DataFrame, ends: list[str]) -> DataFrame:
    """A row per step: its place in `ends`, the pages and records in it, and its end. Only times are read."""
    spark = pages.sparkSession
    cuts = spark.createDataFrame([(ends,)], "ends array<string>").select(F.col("ends").cast("array<timestamp>").alias("ends"))

    def counts(rows: DataFrame, time: str, name: str) -> DataFrame:
        step = _step_of(F.col(time), F.col("ends"), len(ends)).cast("long")
        return rows.select(time).crossJoin(cuts).groupBy(step.alias("batch")).agg(F.count(F.lit(1)).alias(name))

    steps = cuts.select(F.posexplode("ends").alias("batch", "watermark")).withColumn("batch", F.col("batch").cast("long"))
    both = steps.join(counts(pages, "fetched_at", "pages"), "batch", "left").join(counts(records, "source_fetched_at", "records"), "batch", "left")
    return both.select("batch", "pages", F.coalesce("records", F.lit(0).cast("long")).alias("records"), F.col("watermark").cast("string"))

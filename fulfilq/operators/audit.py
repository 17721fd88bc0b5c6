"""Run audit (S10, S16) and the batch high-water mark.

Row counts come from ``Observation`` metrics attached to the write itself, so
counting costs no extra job or scan. The audit log is append-only Parquet;
the next run's lower bound is the latest watermark of successful runs (``>=``,
so the boundary day is re-read and made idempotent by dedup + upsert).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fulfilq.schemas import AUDIT_LOG, GONE


def observation(df: DataFrame, name: str, date_col: str | None = "event_date") -> tuple[Observation, list]:
    """A row count (and max date) metric for ``df``, to attach where the writer executes it once.

    Pass the pair to ``storage.write_partitioned`` / ``write_flat`` (``observe=``);
    ``Observation.get`` is filled when that write finishes.
    """
    live = ~F.col(GONE) if GONE in df.columns else F.lit(True)
    metrics = [F.count_if(live).alias("rows")]
    if date_col and date_col in df.columns:
        metrics.append(F.max(F.when(live, F.col(date_col))).alias("max_date"))
    return Observation(name), metrics


def audit_entries(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Audit rows: job_name, target_table, rows_loaded, run_status, run_ts, watermark_date."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [
        (None, e["job_name"], e["target_table"], e.get("rows_loaded"), e["run_status"],
         e.get("run_ts", now), e.get("watermark_date"))
        for e in entries
    ]
    df = spark.createDataFrame(rows, AUDIT_LOG)
    return df.withColumn("log_id", F.xxhash64("job_name", "target_table", "run_ts"))


def append_audit(spark: SparkSession, path: str, entries: list[dict]) -> None:
    """Append audit rows (one small file per run)."""
    audit_entries(spark, entries).coalesce(1).write.mode("append").parquet(path)


def resolve_watermarks(spark: SparkSession, audit_path: str, targets: list[str], overlap_days: int = 0,
                       lookback_days: int | None = None) -> dict[str, str | None]:
    """Lower bound of an incremental run per target table.

    A target's bound is its own latest successful watermark, ``overlap_days``
    earlier (for folders that land late); a table that failed resumes where it
    last succeeded, whatever the others did. A target without a mark gets
    ``None``, a full load, or today minus ``lookback_days`` where that is passed.
    """
    from fulfilq.sources.storage import path_exists

    marks: dict = {}
    if path_exists(spark, audit_path):
        rows = next_watermark(spark.read.schema(AUDIT_LOG).parquet(audit_path)).collect()  # one row per target
        marks = {r["target_table"]: r["next_watermark"] for r in rows if r["next_watermark"] is not None}
    first = None if lookback_days is None else dt.date.today() - dt.timedelta(days=lookback_days)
    out = {}
    for t in targets:
        day = marks[t] - dt.timedelta(days=overlap_days) if t in marks else first
        out[t] = None if day is None else day.isoformat()
    return out


def next_watermark(audit: DataFrame, target: str | None = None) -> DataFrame:
    """Per target table, the latest watermark of successful runs (lower bound of the next run)."""
    ok = audit.where(F.col("run_status") == "SUCCESS")
    if target is not None:
        ok = ok.where(F.col("target_table") == target)
    return ok.groupBy("target_table").agg(F.max("watermark_date").alias("next_watermark"))

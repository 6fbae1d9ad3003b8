"""Load-job check on a job table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how far back the search for a job goes.
SEARCH_WINDOW = timedelta(minutes=5)


class LoadJobError(RuntimeError):
    """A load job failed, or a destination has none."""


def load_job_status(
    targets: DataFrame,
    jobs: DataFrame,
    *,
    now: Column | None = None,
    window: timedelta = SEARCH_WINDOW,
    job_type: str | None = None,
) -> DataFrame:
    """Status per destination: ``ok``, ``failed`` with its reason, or ``unmatched``.

    ``jobs`` has ``destination``, ``created``, ``error`` (null if none) and, if ``job_type`` is
    given, ``job_type``. Only jobs since ``now - window`` count, and the newest decides; of two
    at the same instant the failed one. Jobs are reduced to one row per destination within the
    tasks before they move.
    """
    end = now if now is not None else F.current_timestamp()
    recent = jobs.where(F.col("created") >= end - F.lit(window))
    if job_type is not None:
        recent = recent.where(F.upper("job_type") == job_type.upper())
    failed = F.when(F.col("error").isNotNull(), F.col("created"))
    newest = recent.groupBy("destination").agg(
        F.max("created").alias("_last"),
        F.max(failed).alias("_failed"),
        F.max_by("error", failed).alias("_reason"),
        F.count(F.lit(1)).alias("jobs"),
    )
    is_failed = F.col("_failed") == F.col("_last")
    status = (
        F.when(F.col("_last").isNull(), "unmatched").when(is_failed, "failed").otherwise("ok")
    )
    return targets.join(newest, "destination", "left").select(
        *targets.columns,
        status.alias("status"),
        F.when(is_failed, F.col("_reason")).alias("reason"),
        F.coalesce("jobs", F.lit(0)).cast("bigint").alias("jobs"),
    )


def require_loaded(status: DataFrame, *, require_match: bool = True) -> None:
    """Raise for a failed destination, and with ``require_match`` for an unmatched one."""
    wrong = ["failed", "unmatched"] if require_match else ["failed"]
    failed = status.where(F.col("status").isin(wrong))
    row = failed.select("destination", "status", "reason").first()
    if row is not None:
        raise LoadJobError(f"{row.destination}: {row.status} {row.reason or ''}".strip())

"""Run log as appended events, folded to the current state of each step."""

from __future__ import annotations

import logging
import time
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.spec import RUN_LOG_SCHEMA

log = logging.getLogger(__name__)
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
REQUIRED = ["run_id", "pipeline_name", "step_name", "status", "started_at", "run_date"]
STATE_COLUMNS = [f.name for f in RUN_LOG_SCHEMA.fields if f.name != "event_time"]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunLog:
    """Writes one event when a step starts and one when it ends. A log that cannot be written never fails the run."""

    def __init__(self, spark: SparkSession, path: str, pipeline_name: str):
        self.spark, self.path, self.pipeline_name = spark, path, pipeline_name
        self._started: dict[int, tuple[str, datetime]] = {}

    def start(self, step_name: str) -> int:
        """Run id of the started step; ids grow with time."""
        run_id, now = time.time_ns() // 1000, _now()
        self._started[run_id] = (step_name, now)
        self._append(run_id, step_name, RUNNING, now, None, None, None, None, now)
        return run_id

    def end(self, run_id: int, status: str, rows: int | None = None, error: str | None = None) -> None:
        step_name, started = self._started.pop(run_id)
        now = _now()
        seconds = Decimal(str((now - started).total_seconds())).quantize(Decimal("0.01"))
        self._append(run_id, step_name, status, started, now, seconds, rows, error, now)

    def _append(self, run_id, step_name, status, started, finished, seconds, rows, error, event_time) -> None:
        event = (run_id, self.pipeline_name, step_name, status, started, finished, seconds, rows, error,
                 started.date(), event_time)
        try:
            values = dict(zip(RUN_LOG_SCHEMA.names, event))
            missing = [name for name in REQUIRED if values[name] is None]
            if missing or status not in (RUNNING, SUCCESS, FAILED):
                raise ValueError(f"event without {', '.join(missing) or 'a known status'}")
            self.spark.createDataFrame([event], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").partitionBy(
                "run_date").parquet(self.path)
        except Exception as problem:  # the log must not stop the run
            log.warning("run log not written: %s", problem)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def current(events: DataFrame) -> DataFrame:
    """Latest state per run id; an end counts as later than a start of the same instant.

    All events of a run share its date. The date is part of the key, so that a filter on it reaches the log's folders.
    """
    latest_first = Window.partitionBy("run_date", "run_id").orderBy(F.desc("event_time"), F.col("finished_at").isNull())
    return (events.withColumn("_age", F.row_number().over(latest_first)).where("_age = 1").select(*STATE_COLUMNS))


def recent(runs: DataFrame, as_of, days: int = 7, rows: int = 50) -> DataFrame:
    """Newest runs of the last days before `as_of` (a date or its text)."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return (runs.where(F.col("run_date") >= since).orderBy(F.desc("run_id")).limit(rows)
            .select("run_date", "pipeline_name", "step_name", "status", "duration_sec", "rows_processed",
                    "error_message"))

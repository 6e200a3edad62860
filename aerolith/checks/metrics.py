"""A log of metrics: measured in the pass that writes, and from the progress of streams."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from datetime import UTC, datetime
from threading import Event, Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: One row a metric: numbers in `value`, all others as text.
LOG = "run_id string, table string, metric string, value double, text string, logged_at timestamp"


def standard_metrics(df: DataFrame, columns: tuple[str, ...] | list[str], time_column: str | None = None, conditions: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Rows, null ratios and bounds of columns, first and last time, and conditional counts: all aggregates that add up while rows pass."""
    out = {"rows": F.count(F.lit(1))}
    for c in columns:
        out |= {f"null_ratio_{c}": F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)), f"min_{c}": F.min(c), f"max_{c}": F.max(c)}
    if time_column:
        out |= {"first": F.min(time_column), "last": F.max(time_column)}
    return out | {k: F.count_if(c) for k, c in (conditions or {}).items()}


def log_rows(spark: SparkSession, path: str, table: str, values: Mapping[str, object], run_id: str) -> None:
    """Append one row a metric to the log, a Parquet table."""
    now = datetime.now(UTC)
    number = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
    rows = [(run_id, table, k, number(v), None if v is None or number(v) is not None else str(v), now) for k, v in values.items()]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)


def write_measured(df: DataFrame, write: Callable[[DataFrame], None], metrics: Mapping[str, Column], table: str, log: str) -> dict[str, object]:
    """Run `write` on `df`, measured by the pass that writes it: no second scan, and no metric of rows that were not written.

    `write` must compute its argument once (as `upsert` and a plain write do), or the first of its passes counts.  If it fails, nothing is logged.  An empty table
    gives 0 rows and null for the others.
    """
    seen = Observation(f"metrics-{uuid.uuid4().hex}")
    write(df.observe(seen, *(c.alias(k) for k, c in metrics.items())))
    got = dict(seen.get)
    log_rows(df.sparkSession, log, table, got, uuid.uuid4().hex)
    return got


class ProgressLog(StreamingQueryListener):
    """Turns the progress of all streams of the session into rows of the log.

    A batch gives its rows, its rate, and what it observed.  The rate is measured by offsets: rows taken in since the last sample over the time since then, never below
    0.  Rows wait in the driver until :meth:`flush`; of a batch that is reported twice the last report counts.
    """

    def __init__(self, clock: Callable[[], float] = time.monotonic):
        self._clock, self._lock = clock, Lock()
        self._ended: dict[str, Event] = {}
        self._waiting: dict[tuple[str, int], dict[str, object]] = {}
        self._last: dict[str, tuple[float, int, int, int]] = {}  # time, rows of all batches before the last, its number and rows

    def sample(self, stream: str, batch: int, rows: int, observed: Mapping[str, object]) -> None:
        now = self._clock()
        with self._lock:
            then, earlier, last, n = self._last.get(stream, (now, 0, batch, 0))
            if batch != last:
                earlier += n
            taken = earlier + rows - (earlier if batch != last else earlier + n)
            rate = max(0.0, taken / max(now - then, 1e-6)) if stream in self._last else 0.0
            self._last[stream] = (now, earlier, batch, rows)
            self._waiting[(stream, batch)] = {"batch": batch, "rows": rows, "rows_per_second": rate, **observed}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = {f"{n}.{k}": v for n, row in (progress.observedMetrics or {}).items() for k, v in row.asDict().items()}
        self.sample(progress.name or str(progress.id), progress.batchId, progress.numInputRows, observed)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.id), Event()).set()

    def drain(self, stream: str, timeout_s: float) -> bool:
        """Wait for the end of a stream to be reported, as reports come after the fact."""
        return self._ended.setdefault(stream, Event()).wait(timeout_s)

    def flush(self, spark: SparkSession, path: str) -> int:
        """Append what waits to the log; gives the number of batches."""
        with self._lock:
            waiting, self._waiting = self._waiting, {}
        for (stream, _), values in sorted(waiting.items()):
            log_rows(spark, path, stream, values, stream)
        return len(waiting)


def latest_metrics(spark: SparkSession, log: str) -> DataFrame:
    """Of each table and metric the newest row of the log."""
    newest = F.max_by(F.struct("run_id", "value", "text"), "logged_at").alias("x")
    return spark.read.schema(LOG).parquet(log).groupBy("table", "metric").agg(newest, F.max("logged_at").alias("logged_at")).select("table", "metric", "x.*", "logged_at")

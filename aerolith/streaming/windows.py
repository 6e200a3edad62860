"""Ingest windows of collectors."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class IngestWindow:
    mode: str
    start: datetime
    end: datetime
    now: datetime

    def state(self) -> dict:
        return {k: v.isoformat() if isinstance(v, datetime) else v for k, v in asdict(self).items()}

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON line, by Spark's writer, so that any of its file systems will do."""
        spark.createDataFrame([(json.dumps(self.state()),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def ingest_window(mode: str, now: datetime, lookback_days: int = 1, lookback_minutes: int = 10, start: datetime | None = None, end: datetime | None = None) -> IngestWindow:
    """The span to ask for: days back in batch mode, minutes back in real time, or the given bounds.

    Lookbacks count at least 1; a start that is not before its end is an error.
    """
    if mode not in ("batch", "realtime"):
        raise ValueError(f"mode must be batch or realtime, not {mode!r}")
    back = timedelta(days=max(1, lookback_days)) if mode == "batch" else timedelta(minutes=max(1, lookback_minutes))
    stop = end or now
    first = start or stop - back
    if first >= stop:
        raise ValueError("the window's start must be before its end")
    return IngestWindow(mode, first, stop, now)


def days_of(window: IngestWindow) -> list[date]:
    """The UTC days that the window touches."""
    first, last = (t.astimezone(UTC).date() for t in (window.start, window.end))
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def months_of(start: date, end: date) -> list[tuple[int, int]]:
    return [(m // 12, m % 12 + 1) for m in range(start.year * 12 + start.month - 1, end.year * 12 + end.month)]

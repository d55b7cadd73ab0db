"""Totals of what a stream observes, over every progress report."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class ProgressTotals(StreamingQueryListener):
    """Adds up the metrics that a query observes under ``name``.

    A query keeps its last 100 reports only; a listener hears all of them. A batch
    that is reported again after a failure counts once. Add the listener before
    the query starts, and give each query a metric name of its own.
    """

    def __init__(self, name: str) -> None:
        self.name = name
        self.totals: dict[str, int] = {}
        self.last_batch = -1

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None or event.progress.batchId <= self.last_batch:
            return
        for key, value in row.asDict().items():
            self.totals[key] = self.totals.get(key, 0) + (value or 0)
        self.last_batch = event.progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery, patience: float = 60.0) -> dict[str, int]:
        """The totals once the query has ended and its last report has been heard."""
        query.awaitTermination()
        observed = [p.batchId for p in query.recentProgress if p.observedMetrics.get(self.name) is not None]
        until = time.monotonic() + patience
        while observed and self.last_batch < observed[-1] and time.monotonic() < until:
            time.sleep(0.05)
        return dict(self.totals)


def counted(rows: DataFrame, name: str) -> DataFrame:
    """Attaches a count of the rows to a stream."""
    return rows.observe(name, F.count("*").alias("rows"))


def health_of(totals: dict[str, int]) -> dict[str, int]:
    """Completed trips, orphaned ends and open starts from the totals of ``stream_health``."""
    done = totals.get("completed_trips", 0)
    return {
        "completed_trips": done,
        "orphaned_ends": totals.get("orphaned_ends", 0),
        "unmatched_starts": totals.get("opened", 0) - done,
    }

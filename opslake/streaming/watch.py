"""Figures of running queries: broken rules observed in the pass that writes, and complete counts of late rows.

A query keeps the progress of its last micro-batches only. The listener here adds up every progress report as it comes, so
counts stay complete however long the query runs.
"""

from __future__ import annotations

import json
import threading
import time
from collections import defaultdict
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Totals(StreamingQueryListener):
    """Sums over all micro-batches of every query it hears of, by the query's id."""

    def __init__(self):
        self.late: dict[str, int] = defaultdict(int)
        self.rows: dict[str, int] = defaultdict(int)
        self.observed: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        with self.changed:
            query = progress["id"]
            self.rows[query] += int(progress["numInputRows"])
            self.late[query] += sum(int(s["numRowsDroppedByWatermark"]) for s in progress["stateOperators"])
            for figures in progress.get("observedMetrics", {}).values():
                for name, value in figures.items():
                    self.observed[query][name] += int(value or 0)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the end of a stopped query has been reported, which comes after all of its progress."""
        limit = time.monotonic() + seconds
        with self.changed:
            while str(query.runId) not in self.ended:
                if not self.changed.wait(limit - time.monotonic()):
                    raise TimeoutError("the end of the query was not reported")


@contextmanager
def totals(spark: SparkSession):
    """A listener that hears all queries of the session inside the block."""
    listener = Totals()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def observed(rows: DataFrame, rules: dict[str, Column], name: str = "rules") -> DataFrame:
    """The rows unchanged; the pass that reads them counts all of them and, by name, those that break a rule."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(rule) for rule, bad in rules.items()])

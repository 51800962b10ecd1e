"""Session history on the second state API: list state, event-time timers or a time to live.

The state needs the RocksDB provider, which ``build_session`` sets; ``with_state_store`` sets it around a query of any
other session.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MESSAGE = "at long, turn long, role string, content string"
#: Rows of a session that are held before the older ones are dropped.
PART = 10_000
#: Time of a message without one, before all others.
NEVER = -(1 << 63)
HISTORY = "session_id string, messages long, first_turn long, last_turn long, history array<struct<turn: long, role: string, content: string>>"


@contextmanager
def with_state_store(spark: SparkSession):
    """The session's state provider is RocksDB inside the block."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def latest_stretch(messages: list[tuple], keep: int, idle_ms: int) -> list[tuple]:
    """The last ``keep`` messages (time, turn, ...) behind the last pause that is longer than the limit.

    The last messages of a session are neighbours, so nothing older is needed to find the pause.
    """
    newest = sorted(messages)[-keep:]
    for i in range(len(newest) - 1, 0, -1):
        if newest[i][0] - newest[i - 1][0] > idle_ms:
            return newest[i:]
    return newest


class SessionHistory(StatefulProcessor):
    """Keeps at most ``keep`` messages per session; a pause beyond the limit starts a new history.

    With event time a timer drops the state once the watermark has passed the limit. With processing time the state store
    drops it by its time to live, as a cache with an expiry does.
    """

    def __init__(self, keep: int, idle_seconds: int, event_time: bool):
        self.keep, self.idle_ms, self.event_time = keep, idle_seconds * 1000, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getListState("messages", MESSAGE, None if self.event_time else self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = known = [tuple(m) for m in self.stored.get()]
        # Rows come in any order; only the newest messages of each part are carried on.
        while part := [(r.at, r.turn, r.role, r.content) for r in islice(rows, PART)]:
            held = latest_stretch(held + part, self.keep, self.idle_ms)
        self.stored.put(held)
        if self.event_time:
            # A timer is there as long as there are messages.
            for timer in list(self.handle.listTimers()) if known else []:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(max(held[-1][0] + self.idle_ms, timerValues.getCurrentWatermarkInMs() + 1))
        yield Row(session_id=key[0], messages=len(held), first_turn=held[0][1], last_turn=held[-1][1],
                  history=[Row(turn=t, role=r, content=c) for _, t, r, c in held])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.stored.clear()
        return iter(())

    def close(self) -> None:
        pass


def session_messages(messages: DataFrame, keep: int = 50, idle_seconds: int = 3600, delay: str = "10 seconds",
                     event_time: bool = True) -> DataFrame:
    """session_id, messages, first_turn, last_turn, history after every micro-batch that brings messages of the session.

    ``messages`` has session_id, turn, role, content and created_at. A message that comes after its session was forgotten
    opens a new history. State per session is bounded by ``keep``. With processing time the engine always plans one more
    batch to look for expired state: run such a query with a fixed trigger, not until nothing is left.
    """
    at = F.coalesce(F.unix_millis("created_at"), F.lit(NEVER)).alias("at")
    rows = messages.select("session_id", "turn", "role", "content", "created_at", at)
    stream = rows.withWatermark("created_at", delay) if event_time else rows
    return stream.groupBy("session_id").transformWithState(
        SessionHistory(keep, idle_seconds, event_time), HISTORY, "Update", "EventTime" if event_time else "ProcessingTime")

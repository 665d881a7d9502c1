"""Buffers that fill over many batches and are flushed by count, bytes or time.

A file sink closes its files at the end of every batch, so a stream of small batches would
leave a file for each. Here records wait in keyed state until their buffer holds enough of
them or its oldest one has waited long enough; only then they reach the sink.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tradelake.streaming.queries import start

# Timers and lists in state need this store.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@dataclass(frozen=True)
class Limits:
    """When a buffer is flushed: at ``records`` or ``size`` bytes, and ``seconds`` after its first record."""

    seconds: float
    records: int | None = None
    size: int | None = None


class Buffer(StatefulProcessor):
    """The waiting records of one key, the oldest first."""

    def __init__(self, keys: list[str], held: T.StructType, line: str, order: str | None, limits: Limits) -> None:
        self.keys, self.held, self.line, self.order, self.limits = keys, held, line, order, limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.held)
        self.about = handle.getValueState("about", "records long, size long, due long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        records, size, due = self.about.get() or (0, 0, 0)
        at = self.held.names.index(self.line)
        kept = records > 0  # whether the state holds some
        for frame in rows:
            if self.order:
                frame = frame.sort_values(self.order, kind="stable")
            # A frame's full buffers leave together: the state is asked twice a frame, not for each.
            full: list[tuple] = []
            fresh: list[tuple] = []
            for row in zip(*(frame[name].tolist() for name in self.held.names)):
                fresh.append(row)
                records, size = records + 1, size + len((row[at] or "").encode()) + 1
                if (self.limits.records and records >= self.limits.records) or (self.limits.size and size >= self.limits.size):
                    if kept:
                        full += self.waiting.get()
                        self.waiting.clear()
                        kept = False
                    full += fresh
                    fresh, records, size = [], 0, 0
                    if due:
                        self.handle.deleteTimer(due)
                    due = 0
            if full:
                yield self._frame(key, full)
            if fresh:
                self.waiting.appendList(fresh)
                kept = True
        if records and not due:
            due = timerValues.getCurrentProcessingTimeInMs() + int(1000 * self.limits.seconds)
            self.handle.registerTimer(due)
        if records:
            self.about.update((records, size, due))
        else:
            self.about.clear()

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        found = list(self.waiting.get())
        self.waiting.clear()
        self.about.clear()
        if found:
            yield self._frame(key, found)

    def _frame(self, key: Any, rows: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame([tuple(row) for row in rows], columns=self.held.names, dtype=object)
        for name, value in zip(self.keys, key):
            found[name] = value
        return found

    def close(self) -> None:
        pass


def buffered(rows: DataFrame, keys: list[str], limits: Limits, line: str = "value", order: str | None = None) -> DataFrame:
    """The rows of a stream, held back until the buffer of their ``keys`` is flushed.

    ``line`` is the column whose bytes count, ``order`` one to sort by what came in a batch.
    A buffer holds at most what its limits allow and one batch of rows, so a key may have
    any number of them; one key is the work of one task. Names of columns that begin with an
    underscore do not reach the state, and are refused.
    """
    if any(name.startswith("_") for name in rows.columns):
        raise ValueError("column names must not begin with an underscore")
    held = T.StructType([f for f in rows.schema.fields if f.name not in keys])
    out = T.StructType([*held.fields, *(rows.schema[name] for name in keys)])
    processor = Buffer(keys, held, line, order, limits)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, out, "Append", "ProcessingTime")


def start_buffered(
    writer: DataStreamWriter, spark, path: str, checkpoint: str, tasks: int | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Start a sink of buffered rows with the state store they need, on ``tasks`` tasks if given.

    A run without end, such as every second, also flushes by time; after a restart it does so
    from its first batch with input on. A bounded run reads what is there, flushes what is
    full or due and leaves the rest in its checkpoint for the next run.
    """
    chosen = dict(STORE)
    if tasks:
        chosen["spark.sql.shuffle.partitions"] = str(tasks)
    bounded = trigger is None or "availableNow" in trigger
    # Timers would keep a bounded run going for ever: it ends with its data.
    chosen["spark.sql.streaming.noDataMicroBatches.enabled"] = str(not bounded).lower()
    before = {key: spark.conf.get(key) for key in chosen}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    try:
        return start(writer, path, checkpoint, trigger)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def drain(query: StreamingQuery, limits: Limits, wait: float = 300) -> None:
    """Let a run without end read its input and flush all its buffers, then stop it.

    What came in by the end of one batch is due ``limits.seconds`` later at most, so the
    first batch without input that began after that has flushed the last buffer. ``wait``
    bounds the seconds without a batch at work, not those that batches take.
    """
    until = time.monotonic() + wait
    base = datetime.now(timezone.utc)
    seen = None
    while query.exception() is None and time.monotonic() < until:
        last = query.lastProgress
        at = (last or {}).get("batchId")
        if at != seen or (query.status["isTriggerActive"] and (last is None or query.status["isDataAvailable"])):
            seen, until = at, time.monotonic() + wait
        if last:
            began = datetime.fromisoformat(last["timestamp"])
            if last["numInputRows"]:
                base = max(base, began + timedelta(milliseconds=last["durationMs"]["triggerExecution"]))
            elif "addBatch" in last["durationMs"] and began >= base + timedelta(seconds=limits.seconds):
                query.stop()
                return
        time.sleep(0.1)
    failed = query.exception()
    query.stop()
    raise failed or TimeoutError("buffers were still waiting")

"""Buffers that leave together, and waiting for a batch at work."""

from __future__ import annotations

from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.sql import types as T

from tradelake.streaming.buffering import Buffer, Limits, drain


class State:
    """A list and a value that count how often they are asked."""

    def __init__(self):
        self.rows, self.value, self.calls = [], None, 0

    def get(self):
        self.calls += 1
        return iter(list(self.rows)) if self.value is None and self.rows else self.value or iter(())

    def clear(self):
        self.calls += 1
        self.rows, self.value = [], None

    def appendList(self, rows):  # noqa: N802
        self.calls += 1
        self.rows += rows


class About(State):
    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Clock:
    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return 0


class Handle:
    def registerTimer(self, due):  # noqa: N802
        pass

    deleteTimer = registerTimer  # noqa: N815


@pytest.mark.parametrize("limits", [Limits(1, records=10), Limits(1, size=30)])
def test_full_buffers_leave_together(limits):
    buffer = Buffer(["key"], T.StructType().add("value", "string").add("at", "long"), "value", "at", limits)
    buffer.handle, buffer.waiting, buffer.about = Handle(), State(), About()
    frames = []
    for first in range(0, 3000, 1005):
        some = range(first, min(first + 1005, 3000))
        batch = pd.DataFrame({"value": ["ab"] * len(some), "at": some})
        frames += buffer.handleInputRows(("k",), iter([batch]), Clock())
    frames += buffer.handleExpiredTimer(("k",), Clock(), None)
    assert [k for f in frames for k in f["at"]] == list(range(3000))
    # One frame for each batch, not for each ten records, and as few requests to the state.
    assert len(frames) <= 4 and buffer.waiting.calls <= 12
    assert all(len(f) % 10 == 0 for f in frames)


def test_drain_waits_for_a_batch_at_work():
    class Query:
        lastProgress = None  # noqa: N815
        stopped, asked = False, 0

        @property
        def status(self):
            self.asked += 1
            if self.asked == 10:  # the first batch took ten looks; then a batch without input
                began = datetime.now(timezone.utc).isoformat()
                self.lastProgress = {"batchId": 1, "timestamp": began.replace("+00:00", "Z"), "numInputRows": 0, "durationMs": {"addBatch": 1, "triggerExecution": 1}}
            return {"isTriggerActive": True, "isDataAvailable": self.lastProgress is None}

        def exception(self):
            return None

        def stop(self):
            self.stopped = True

    query = Query()
    drain(query, Limits(0), wait=0.3)
    assert query.stopped and query.asked >= 10
    query.asked, query.lastProgress, query.stopped = 20, {"batchId": 1, "numInputRows": 0, "durationMs": {}, "timestamp": datetime.now(timezone.utc).isoformat()}, False
    with pytest.raises(TimeoutError):
        drain(query, Limits(0), wait=0.3)

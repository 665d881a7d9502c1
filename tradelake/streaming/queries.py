"""Starting streaming queries and counting what they read."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tradelake.operators.trades import format_events
from tradelake.operators.validation import decode_envelope

# Read all there is now, in batches as the source's limits cut them, then stop.
NOW = {"availableNow": True}


def start(writer: DataStreamWriter, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a file sink. Its commit log makes each batch appear once, also after a restart."""
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or NOW))
        .start()
    )


def finish(*queries: StreamingQuery) -> None:
    """Wait for bounded queries; a failed one raises here."""
    for query in queries:
        query.awaitTermination()


class BatchCounter(StreamingQueryListener):
    """Rows that each batch of a query read, from the events of all its batches.

    A query's own ``recentProgress`` forgets old batches. Use it as a context: queries
    started inside are counted, and ``counts`` waits until a stopped query's last
    event has come.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.rows: dict[str, dict[int, int]] = {}
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> BatchCounter:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows.setdefault(str(event.runId), {})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if progress.numInputRows:
            self.rows.setdefault(str(progress.runId), {})[progress.batchId] = progress.numInputRows

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended[str(event.runId)].set()

    def counts(self, query: StreamingQuery, wait: float = 60) -> list[tuple[int, int]]:
        """Number and rows of each batch of a finished query that read something."""
        if not self.ended[str(query.runId)].wait(wait):
            raise TimeoutError("the query's end was not reported")
        return sorted(self.rows.get(str(query.runId), {}).items())


def display(stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Print each record of a log stream: a short line and the whole event."""
    shown = format_events(decode_envelope(stream)).select("line", "full_event")
    return (
        shown.writeStream.format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or NOW))
        .start()
    )

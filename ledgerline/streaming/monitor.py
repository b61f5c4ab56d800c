"""What streams report about themselves: readiness, end, and the counts of every batch.

Spark pushes these events; nothing polls and nothing is counted twice. The counts come from ``observe`` on the
streaming frame, so they are made by the pass that reads the messages.
"""

from __future__ import annotations

import threading
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerline.operators.quality import MINIMUM_ROWS, checks_on_count

BATCH_COUNTS = "batch_counts"
COUNTS = "query string, batch_id long, messages long, accepted long, rejected long, finished timestamp"
STATES = "query string, id string, state string, batches long, error string"


class StreamMonitor(StreamingQueryListener):
    """Attach before a stream starts; keeps the counts of the ``most`` latest batches."""

    def __init__(self, spark: SparkSession, most: int = 10_000):
        self.spark = spark
        self.most = most
        self._changed = threading.Condition()
        self._states: dict[str, list] = {}
        self._batches: OrderedDict[tuple[str, int], tuple] = OrderedDict()
        self._ended: set[str] = set()

    def __enter__(self) -> StreamMonitor:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    # -- events ----------------------------------------------------------------------------------

    def _note(self, query_id, state: str, error: str | None = None, name: str | None = None, batch: tuple | None = None):
        with self._changed:
            row = self._states.setdefault(str(query_id), [name, str(query_id), state, 0, None])
            row[0] = name or row[0]
            row[2], row[4] = state, error
            if batch is not None:
                key = (str(query_id), batch[1])
                row[3] += key not in self._batches
                self._batches[key] = batch
                if len(self._batches) > self.most:
                    self._batches.popitem(last=False)
            self._changed.notify_all()

    def onQueryStarted(self, event) -> None:
        self._note(event.id, "starting", name=event.name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(BATCH_COUNTS)
        batch = None
        if counts is not None and progress.numInputRows:
            batch = (progress.name, progress.batchId, counts["messages"], counts["accepted"], counts["rejected"], progress.timestamp)
        self._note(progress.id, "running", name=progress.name, batch=batch)

    def onQueryIdle(self, event) -> None:
        self._note(event.id, "running")

    def onQueryTerminated(self, event) -> None:
        self._note(event.id, "failed" if event.exception else "stopped", event.exception)
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    # -- answers ---------------------------------------------------------------------------------

    def _state(self, query: StreamingQuery) -> str | None:
        row = self._states.get(str(query.id))
        return row[2] if row else None

    def wait_until_ready(self, query: StreamingQuery, timeout: float = 180.0) -> bool:
        """True once the stream has finished a batch or waits for data; False when it ends or time is up."""
        with self._changed:
            self._changed.wait_for(lambda: self._state(query) not in (None, "starting"), timeout)
            return self._state(query) == "running"

    def wait_until_ended(self, query: StreamingQuery, timeout: float | None = None) -> bool:
        """True once the run's last event is here; by then all its counts are."""
        with self._changed:
            return self._changed.wait_for(lambda: str(query.runId) in self._ended, timeout)

    def status(self) -> DataFrame:
        """A row for each stream: starting, running, stopped or failed, its batches and its error."""
        with self._changed:
            rows = [tuple(row) for row in self._states.values()]
        return self.spark.createDataFrame(rows, STATES)

    def batches(self) -> DataFrame:
        """A row for each batch with messages, with how many had an order id and how many were set aside."""
        with self._changed:
            rows = list(self._batches.values())
        text = COUNTS.replace("finished timestamp", "finished string")
        return self.spark.createDataFrame(rows, text).withColumn("finished", F.to_timestamp("finished"))

    def checks(self, minimum_rows: int = MINIMUM_ROWS) -> DataFrame:
        """The volume checks on all accepted messages, without reading the table."""
        total = F.coalesce(F.sum("accepted"), F.lit(0).cast("long"))
        return checks_on_count(self.batches().agg(total.alias("observed")), minimum_rows)

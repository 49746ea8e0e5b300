"""Counters of a running ingest, micro-batch by micro-batch.

Spark posts a progress event after every micro-batch; a listener keeps what the
ingest counts of it: the rows that its plan observed while they passed, and what
its state store dropped.  No job of its own is run, and the running query does
not wait for it.
"""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tillroll.streaming.pipeline import OBSERVED

KEPT = 10_000  # of a long-running query the last micro-batches only
_ROW = "batch_id bigint, input_rows bigint, matched_rows bigint, quarantined_rows bigint, repeated_rows bigint, late_rows bigint, seconds double"


class IngestProgress(StreamingQueryListener):
    """Listens to the queries of one name; use as a context manager around their run.

    ``on_row`` is called with each micro-batch's counters as they come in.
    """

    def __init__(self, spark: SparkSession, name: str = "tillroll_ingest", on_row: Callable[[dict], None] | None = None):
        self.spark, self.name, self.on_row = spark, name, on_row
        self.rows: deque[dict] = deque(maxlen=KEPT)
        self._ids: set[str] = set()
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._change:
            if event.name == self.name:
                self._ids.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name:
            return
        seen = p.observedMetrics.get(OBSERVED)
        state = p.stateOperators
        row = {
            "batch_id": p.batchId,
            "input_rows": int(seen["input_rows"]) if seen else p.numInputRows,
            "matched_rows": int(seen["matched_rows"]) if seen else None,
            "quarantined_rows": int(seen["quarantined_rows"]) if seen else None,
            "repeated_rows": sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in state),
            "late_rows": sum(int(s.numRowsDroppedByWatermark) for s in state),
            "seconds": p.batchDuration / 1000,
        }
        self.rows.append(row)
        if self.on_row is not None:
            self.on_row(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, seconds: float = 60) -> None:
        """Events come in behind the query: returns when the end of all that have started is known."""
        with self._change:
            if not self._change.wait_for(lambda: self._ids <= self._ended, seconds):
                raise TimeoutError(f"no end of query {self.name} within {seconds} s")

    def table(self) -> DataFrame:
        """A row per micro-batch."""
        names = [c.split()[0] for c in _ROW.split(", ")]
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in self.rows], _ROW)

    def __enter__(self) -> "IngestProgress":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        try:
            if exc[0] is None:
                self.wait()
        finally:
            self.spark.streams.removeListener(self)

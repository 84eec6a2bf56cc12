"""The ingest command: a stream into bronze that reports its progress and can be stopped."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pacewise.operators.maintenance import merge_batches
from pacewise.operators.silver import merge_events
from pacewise.sources import fs
from pacewise.sources.tables import Lake
from pacewise.streaming import bronze


FOLD_EVERY = 360  # batches: an hour of ten-second triggers


class Progress(StreamingQueryListener):
    """One JSON line for each batch of the query ``name``, and for its start and end."""

    def __init__(self, name: str, log: Callable[[str], None]) -> None:
        self.name, self.log = name, log
        self.run = None
        self.rows = self.batches = 0

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        if event.name == self.name:
            self.run = event.runId
            self.log(json.dumps({"event": "started", "query": self.name}))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.runId == self.run and p.numInputRows:
            self.rows += p.numInputRows
            self.batches += 1
            self.log(json.dumps({"event": "batch", "query": self.name, "batch": p.batchId, "rows": p.numInputRows,
                                 "rows_per_second": p.processedRowsPerSecond, "ms": dict(p.durationMs)}))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.runId == self.run:
            self.log(json.dumps({"event": "ended", "query": self.name, "rows": self.rows, "error": event.exception}))


def stop_marker(lake: Lake, tag: str) -> str:
    """The file whose presence asks the ingest of ``tag`` to stop."""
    return lake.folder("_control", f"stop-{tag}")


def request_stop(spark: SparkSession, lake: Lake, tag: str) -> None:
    fs.write_text(spark, stop_marker(lake, tag), "")


def _stopped(query: StreamingQuery, grace: float) -> None:
    """Stops between two batches; a batch still running after ``grace`` seconds is left to the next start."""
    until = time.monotonic() + grace
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.1)
    query.stop()


def ingest(spark: SparkSession, lake: Lake, raw: DataFrame, tag: str = "ingest", processing_time: str = "10 seconds",
           available_now: bool = False, silver: bool = False, fold_every: int = FOLD_EVERY, grace: float = 60,
           poll: float = 1, log: Callable[[str], None] = print) -> dict[str, int]:
    """Runs the stream until it has ended (``available_now``), failed, or ``request_stop`` was called.

    With ``silver`` every batch is merged into the silver table as well. After every ``fold_every`` batches the
    folders of those before the newest become one, so their number stays small however long the stream runs
    (a trigger of ten seconds makes 8,640 batches a day). Started again, it goes on from its
    checkpoint in the lake; a marker left from before is removed first.
    """
    fs.delete(spark, stop_marker(lake, tag), recursive=False)
    name = f"bronze-{tag}-{time.time_ns()}"
    progress = Progress(name, log)
    spark.streams.addListener(progress)
    try:
        def after(batch: DataFrame, batch_id: int) -> None:
            if silver:
                merge_events(spark, lake["silver"], batch)
            if fold_every and batch_id % fold_every == fold_every - 1:
                merge_batches(spark, lake["bronze"], tag)  # between two writes of this stream
        query = bronze.start(spark, raw, lake["bronze"], lake.folder("_checkpoints", tag), tag, processing_time,
                             available_now, on_batch=after, name=name)
        while not query.awaitTermination(poll):
            if fs.exists(spark, stop_marker(lake, tag)):
                _stopped(query, grace)
        if query.exception():
            raise RuntimeError(f"the stream of {tag} failed: {query.exception()}")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)  # the last events are delivered
    finally:
        spark.streams.removeListener(progress)
    return {"batches": progress.batches, "rows": progress.rows}

"""Run control for a replayed strategy run.

A run owns a fresh ``run_id`` and its own checkpoint, source and history
folders under the shared checkpoint directory. Starting a new run stops the
previous query first; restarting on the same checkpoint resumes where the
stopped query left off.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barflow.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def trigger_options(interval_ms: int | None, floor_ms: int = 0, available_now: bool = False) -> dict:
    """Processing-time trigger in ms (clamped to ``floor_ms``); None = as
    fast as possible; ``available_now`` = process what is there, then stop."""
    if available_now:
        return {"availableNow": True}
    if interval_ms is None:
        return {}
    return {"processingTime": f"{max(int(interval_ms), int(floor_ms))} milliseconds"}


@dataclass
class Run:
    spark: SparkSession
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    query: StreamingQuery | None = None
    _session: SparkSession | None = field(default=None, repr=False)

    @property
    def session(self) -> SparkSession:
        """The run's own session, for its streams: the caller's settings, and RocksDB for states larger than memory.

        What a run sets there is not seen by the caller's session."""
        if self._session is None:
            self._session = self.spark.newSession()
            for name, value in self.spark.conf.getAll.items():
                if name.startswith("spark.sql.") and self.spark.conf.isModifiable(name):
                    self._session.conf.set(name, value)
            self._session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
            # A commit uploads what changed, not the whole store.
            self._session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        return self._session

    @property
    def folder(self) -> str:
        return scratch_path(self.spark, "runs", self.run_id)

    @property
    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint"

    def start(self, stream: DataFrame, foreach_batch=None, interval_ms: int | None = None,
              fmt: str | None = None, path: str | None = None, output_mode: str = "append",
              state_partitions: int | None = None, available_now: bool = False, floor_ms: int = 0) -> StreamingQuery:
        """Stop the current query (if any) and start ``stream``.

        ``state_partitions`` sets the number of state-store partitions of a new
        stateful query (fixed in its checkpoint from then on). The stream must come from
        this run's ``session`` for that and for the state store to hold; a stream of
        another session runs with that session's settings."""
        self.stop()
        w = stream.writeStream.option("checkpointLocation", self.checkpoint).outputMode(output_mode)
        trig = trigger_options(interval_ms, floor_ms, available_now)
        if trig:
            w = w.trigger(**trig)
        if foreach_batch is not None:
            w = w.foreachBatch(foreach_batch)
        elif fmt is not None:
            w = w.format(fmt)
            if path is not None:
                w = w.option("path", path)
        if state_partitions:
            self.session.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
        self.query = w.start()
        return self.query

    def drain(self, stream: DataFrame, **how) -> list[dict]:
        """Process all that the source holds now on this run's checkpoint, then end; returns the
        progress reports. A source whose files are all there before the call is read without gaps."""
        query = self.start(stream, available_now=True, **how)
        try:
            query.awaitTermination()
            return list(query.recentProgress)
        finally:
            self.stop()

    def stop(self) -> None:
        if self.query is not None:
            try:
                self.query.stop()
            finally:
                self.query = None

    def new_rows(self) -> int:
        """Input rows of the last micro-batch (0 when idle)."""
        if self.query is None or self.query.lastProgress is None:
            return 0
        return int(self.query.lastProgress.get("numInputRows", 0))


def new_run(spark: SparkSession, previous: Run | None = None) -> Run:
    """Start-over semantics: the old query stops, the new run gets a new id,
    so its history starts empty (S14) without deleting anything."""
    if previous is not None:
        previous.stop()
    return Run(spark)

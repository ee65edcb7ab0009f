"""SNK-7 run audit: each run appends its start and its end (success with records
and metadata, or failure with a message) to an append-only table of events;
:func:`wardpulse.operators.sinks.run_state` tells the current state of each run.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

EVENTS = ("run_id string, pipeline string, status string, records_loaded long, error_message string, "
          "metadata string, ts timestamp, seq int")


class RunAudit:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _write(self, run_id: str, pipeline: str, status: str, seq: int, records: int | None = None,
               message: str | None = None, metadata: dict | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = (run_id, pipeline, status, records, message, json.dumps(metadata) if metadata else None, now, seq)
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, pipeline: str, metadata: dict | None = None) -> str:
        run_id = uuid.uuid4().hex
        self._write(run_id, pipeline, "running", 0, metadata=metadata)
        return run_id

    def success(self, run_id: str, pipeline: str, records: int, metadata: dict | None = None) -> None:
        self._write(run_id, pipeline, "success", 1, records=records, metadata=metadata)

    def failure(self, run_id: str, pipeline: str, message: str) -> None:
        self._write(run_id, pipeline, "failed", 1, message=message[:2000])

    @contextmanager
    def run(self, pipeline: str, metadata: dict | None = None):
        """Audit a block: it sets ``records`` in the dictionary it gets. An error is
        recorded and raised again."""
        run_id = self.start(pipeline, metadata)
        told: dict = {"run_id": run_id, "records": 0}
        try:
            yield told
        except BaseException as e:
            self.failure(run_id, pipeline, f"{type(e).__name__}: {e}")
            raise
        self.success(run_id, pipeline, told["records"], told.get("metadata"))

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(self.path)

    def state(self) -> DataFrame:
        from wardpulse.operators.sinks import run_state
        return run_state(self.events(), seq="seq")

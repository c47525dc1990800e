"""Progress of streaming queries as rows of an ops table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query string, query_id string, batch_id bigint, event string, input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, batch_duration_ms bigint, "
    "rows_dropped_late bigint, error string, recorded_at timestamp"
)


class ProgressLog(StreamingQueryListener):
    """Buffers one row per trigger and appends them to a Parquet table in groups."""

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 20):
        self._spark, self._path, self._flush_every = spark, path, flush_every
        self._rows: list[tuple] = []

    def _add(self, *row) -> None:
        self._rows.append((*row, datetime.now(timezone.utc)))

    def flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(
                self._path
            )

    def onQueryStarted(self, event) -> None:
        self._add(event.name, str(event.id), None, "started", None, None, None, None, None, None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self._add(
            p.name, str(p.id), p.batchId, "progress", p.numInputRows, p.inputRowsPerSecond,
            p.processedRowsPerSecond, p.batchDuration, late, None,
        )
        if len(self._rows) >= self._flush_every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        kind = "failed" if event.exception else "terminated"
        self._add(
            None, str(event.id), None, kind, None, None, None, None, None, event.exception
        )
        self.flush()

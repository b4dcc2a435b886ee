"""Stream progress as data: one row per micro-batch, with the metrics a
query registers through ``observe`` (records written per sink, etc.)."""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


LOGGED = "query string, batch_id long, input_rows long, duration_ms long"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, in place of an earlier one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def logged(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a log's folder, one per query and batch."""
    return spark.read.schema(LOGGED).option("recursiveFileLookup", "true").json(folder)


class ProgressLog(StreamingQueryListener):
    """Collects one small dict per batch on the driver: the last ``keep`` of
    them.  With a ``folder``, every row is also written there when it comes, as
    ``<query>/<batch>.json``: nothing is lost beyond ``keep`` rows, and a batch
    that is reported again replaces its own row (``logged`` reads them).
    Without one, ``write`` appends what has come since the last call."""

    def __init__(self, keep: int = 10_000, spark: SparkSession | None = None, folder: str | None = None):
        if folder and spark is None:
            raise ValueError("a folder needs a session to write with")
        self.spark, self.folder = spark, folder and folder.rstrip("/")
        self.rows: deque[dict] = deque(maxlen=keep)
        self.states: deque[tuple[str, str]] = deque(maxlen=keep)
        self.failed = 0

    def onQueryStarted(self, event) -> None:
        self.states.append((str(event.id), "started"))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        metrics = {}
        for name, row in (p.observedMetrics or {}).items():
            for k, v in row.asDict().items():
                metrics[f"{name}.{k}"] = v
        row = {"query": p.name, "batch_id": p.batchId, "input_rows": p.numInputRows,
               "duration_ms": int(p.batchDuration), **metrics}
        self.rows.append(row)
        if self.folder:
            write_text(self.spark, f"{self.folder}/query={p.id}/{p.batchId}.json", json.dumps(row, default=str) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failed += bool(event.exception)
        self.states.append((str(event.id), "failed" if event.exception else "terminated"))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = list(self.rows)
        return spark.createDataFrame(rows) if rows else spark.createDataFrame(
            [], LOGGED)

    def write(self, spark: SparkSession, folder: str) -> int:
        """Append the rows so far to ``folder`` as JSON and forget them; returns their number."""
        rows = [self.rows.popleft() for _ in range(len(self.rows))]
        if rows:
            lines = [(json.dumps(r, default=str),) for r in rows]
            spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(folder)
        return len(rows)

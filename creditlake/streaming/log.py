"""The run log of a streaming query, taken from the progress that Spark reports.

A batch gets its line after it is committed. A driver that is lost between the
commit and the line leaves a batch without one; its alerts are stored all the same.
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

ARRIVED, RAISED = "arrived", "raised"
LINE = (
    "run_id string, batch bigint, event_time timestamp, events_processed bigint, alerts_emitted bigint, threshold int"
)


class RunLog(StreamingQueryListener):
    """Appends a line per micro-batch of the query called ``name`` to the JSON lines in ``folder``.

    The query observes ``events`` under :data:`ARRIVED` and ``alerts`` under :data:`RAISED`.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, threshold: int):
        self._spark, self._name, self._folder, self._threshold = spark, name, folder, threshold
        self._run: str | None = None
        self._done = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self._name:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self._name:
            return
        seen = progress.observedMetrics
        # An idle query reports its last batch again, without metrics.
        if ARRIVED not in seen:
            return
        raised = seen[RAISED]["alerts"] if RAISED in seen else 0
        moment = datetime.now(timezone.utc).replace(microsecond=0)
        line = (str(progress.runId), progress.batchId, moment, seen[ARRIVED]["events"], raised, self._threshold)
        self._spark.createDataFrame([line], LINE).coalesce(1).write.mode("append").json(self._folder)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self._run is not None and str(event.runId) == self._run:
            self._done.set()

    def wait(self, seconds: float | None = None) -> bool:
        """Wait until the line of the last batch is written."""
        return self._done.wait(seconds)


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """A line per micro-batch, each once."""
    try:
        lines = spark.read.schema(LINE).json(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], LINE)
    return lines.dropDuplicates(["run_id", "batch"])


def runs(log: DataFrame) -> DataFrame:
    """A line per run, that is per start of the query, numbered in their order."""
    return log.groupBy("run_id", "threshold").agg(
        F.min("batch").alias("first_batch"),
        F.count(F.lit(1)).alias("batches"),
        F.max("event_time").alias("event_time"),
        F.sum("events_processed").alias("events_processed"),
        F.sum("alerts_emitted").alias("alerts_emitted"),
    )

"""Transaction alerts as a Structured Streaming job.

Events are scored per customer in the order of their event time, by state that
Spark keeps (:mod:`.state`): RocksDB on the executors, its changes in the
checkpoint. A micro-batch touches the customers that it has events or due timers
for, and no others. Events may arrive in any order within ``delay``, the watermark;
alerts come out when the watermark passes their event. Only transactions that can
alert at all are shuffled.

* ``alerts``  the file sink; its own log makes every alert appear exactly once,
  also after a restart or a batch that runs again
* ``log``     a line per micro-batch with its events and alerts (:mod:`.log`)

The stream gives the alerts of the batch operator over the same events, with two
differences. An event later than the watermark is scored when it comes. An event
id belongs to one customer; under two it may alert once for each.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import MAX_SCORE, POINTS_PER_ALERT, now
from ..operators.alerts import MAX_STATE, THRESHOLD, scored_events
from ..sources.schemas import STREAM_ALERT, STREAM_EVENT
from .log import ARRIVED, RAISED, RunLog
from .log import read_log as read_log_lines
from .state import ALERT, AlertState

DELAY = "1 hour"
# The transaction type of a line that only moves the watermark.
MARK = "end_of_period"

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def read_events(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """JSON-lines event files that arrive in ``folder``; a malformed line fails the job."""
    return (
        spark.readStream.schema(STREAM_EVENT)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def write_events(events: DataFrame, folder: str) -> None:
    """Append events to ``folder`` as JSON lines, one file per partition, times to the microsecond."""
    events.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(folder)


def end_period(spark: SparkSession, folder: str, until: datetime, delay: str = DELAY) -> None:
    """Tell a stream over ``folder`` that all events before ``until`` have arrived.

    Adds a file with one line whose time is ``delay`` after ``until``, so that the
    watermark reaches ``until`` and what waits for it comes out.
    """
    moment = F.lit(until).cast("timestamp") + F.expr(f"INTERVAL {delay}")
    line = spark.range(1).select(F.lit(MARK).alias("transaction_type"), moment.alias("event_time"))
    write_events(line.coalesce(1), folder)


def _is_mark() -> Column:
    return (F.col("transaction_type") == MARK) & F.col("event_id").isNull()


def alert_rows(events: DataFrame, threshold: int = THRESHOLD, delay: str = DELAY, known: DataFrame | None = None) -> DataFrame:
    """The alerts of a stream of events. ``known`` (customer_id, event_id) have alerted before it began."""
    mark = F.coalesce(_is_mark(), F.lit(False))
    counted = events.observe(ARRIVED, F.count_if(~mark).alias("events"))
    scored = scored_events(counted.withColumn("_seen", F.col("event_time")).withWatermark("_seen", delay), threshold, "_seen", mark.alias("is_mark"))
    # Naming the event time keeps the filter above the watermark, which all events move.
    never = F.col("_seen") < F.lit("0001-01-01").cast("timestamp")
    wanted = scored.filter(F.col("is_mark") | F.col("possible") | F.coalesce(never, F.lit(False)))
    rows = wanted.select(
        "customer_id",
        F.unix_micros(F.col("event_time").cast("timestamp")).alias("at"),
        "event_id",
        "transaction_id",
        F.col("_base").alias("base"),
        F.col("_need").alias("need"),
        "rule_name",
        "is_mark",
    )
    before = None
    if known is not None:
        before = known.select(F.coalesce("customer_id", F.lit("")).alias("customer_id"), "event_id").groupBy("customer_id")
    state = AlertState(POINTS_PER_ALERT, MAX_STATE, MAX_SCORE)
    alerts = rows.groupBy("customer_id").transformWithState(state, ALERT, "Append", "EventTime", before)
    return alerts.observe(RAISED, F.count(F.lit(1)).alias("alerts")).select(
        "alert_id", "transaction_id", "customer_id", now().alias("alert_time"), "rule_name", "risk_score", "alert_status"
    )


class AlertJob:
    """A running alert stream and its log."""

    def __init__(self, spark: SparkSession, query: StreamingQuery, log: RunLog):
        self.query, self._spark, self._log = query, spark, log

    def awaitTermination(self) -> None:
        """Wait for the end of the query, and for the log of its last batch."""
        try:
            self.query.awaitTermination()
        finally:
            self._log.wait(60)
            self._spark.streams.removeListener(self._log)

    def stop(self) -> None:
        self.query.stop()
        self.awaitTermination()


def start_alerts(
    events: DataFrame,
    target: str,
    checkpoint: str,
    threshold: int = THRESHOLD,
    trigger: dict | None = None,
    delay: str = DELAY,
    known: DataFrame | None = None,
    partitions: int | None = None,
) -> AlertJob:
    """Start the job. Without a ``trigger`` it handles what is there and stops.

    ``partitions`` of the state are fixed at the first start of a checkpoint;
    without it they are the shuffle partitions of the session.
    """
    spark = events.sparkSession
    name = f"alerts-{uuid.uuid4().hex}"
    log = RunLog(spark, name, f"{target}/log", threshold)
    settings = dict(STATE_STORE)
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in settings}
    writer = (
        alert_rows(events, threshold, delay, known)
        .writeStream.queryName(name)
        .format("json")
        .outputMode("append")
        .option("path", f"{target}/alerts")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    spark.streams.addListener(log)
    try:
        # A query keeps the settings that it is started with.
        for key, value in settings.items():
            spark.conf.set(key, value)
        query = writer.start()
    except BaseException:
        spark.streams.removeListener(log)
        raise
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return AlertJob(spark, query, log)


def read_alerts(spark: SparkSession, target: str) -> DataFrame:
    """All alerts of the committed batches."""
    try:
        return spark.read.schema(STREAM_ALERT).json(f"{target}/alerts")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], STREAM_ALERT)


def read_log(spark: SparkSession, target: str) -> DataFrame:
    """Events, alerts and threshold of every micro-batch."""
    return read_log_lines(spark, f"{target}/log")


def all_alerts(batch_alerts: DataFrame, stream_alerts: DataFrame) -> DataFrame:
    """Batch and stream alerts under one schema."""
    return batch_alerts.unionByName(stream_alerts.withColumnRenamed("alert_time", "alert_timestamp"))

"""Streams of files and of change events into a target."""

from __future__ import annotations

import datetime
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..plans.store import Target
from ..sources import CsvDialect


def csv_stream(spark: SparkSession, path: str, schema: str, dialect: CsvDialect = CsvDialect(), files: int = 1000) -> DataFrame:
    """New files below ``path``, oldest first; the stream's log tracks paths, so files of one time are all read."""
    return spark.readStream.options(**dialect.options()).option("maxFilesPerTrigger", files).schema(schema).csv(path)


def change_stream(spark: SparkSession, path: str, schema: str, since: Any = None, form: str = "parquet", files: int = 1000) -> DataFrame:
    """Change records from files below ``path``; ``since``: only those of that time or later.

    ``since`` is the log position that was kept before a snapshot (``sources.log_position``). Records of that very time come once more,
    which a merge by order doesn't mind. After a restart the checkpoint goes on where it was; a null time is
    never before ``since``, so its record stays.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(path)
    return rows if since is None else rows.where(F.col("_ts").isNull() | (F.col("_ts") >= F.lit(since)))


@dataclass(frozen=True)
class LogSource:
    """An object that is read by its log: its rows now, the log's newest time now, and the log's change records since a time as a stream.

    ``position`` is called before the rows are read, so records that fall between the two come with the log once more.
    """

    snapshot: DataFrame
    position: Callable[[], Any]
    changes: Callable[[Any], DataFrame]


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that belongs to a checkpoint folder: made with it, the same after a restart."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/target-stream-id")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, False)
        try:
            out.write(bytearray(uuid.uuid4().hex.encode()))
        finally:
            out.close()
    found = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8")
    finally:
        found.close()


class RunLogListener(StreamingQueryListener):
    """Appends a row to a run log for every micro-batch of one named query, from the metrics observed in it, and one if the query fails.

    Spark tells of progress on a thread of its own; ``done`` is set once the end of the query was told, and with it all rows are written.
    """

    def __init__(self, spark: SparkSession, query: str, obj: str, log_path: str, schema: str) -> None:
        self.spark, self.query, self.object, self.log_path, self.schema = spark, query, obj, log_path, schema
        self.done, self.run_id, self.id = threading.Event(), uuid.uuid4().hex, None

    def _row(self, began: datetime.datetime, ended: datetime.datetime, records: int, status: str, said: str, keys: dict[str, str], commit: int | None) -> None:
        row = (self.run_id, self.object, "SNAPSHOT + LOG_BASED", "READ", began, ended, records, status, said, keys, [], 0, 0, commit)
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.log_path)

    def onQueryStarted(self, event: Any) -> None:
        if event.name == self.query:
            self.id = str(event.runId)

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        if str(p.runId) != self.id or self.query not in p.observedMetrics or not p.observedMetrics[self.query].records:
            return
        seen = p.observedMetrics[self.query]
        began = datetime.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone().replace(tzinfo=None)
        ended = began + datetime.timedelta(milliseconds=p.durationMs.get("triggerExecution", 0))
        self._row(began, ended, seen.records, "SUCCESS", "", {"_ts": str(seen.max_ts)} if seen.max_ts else {}, p.batchId)

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        if str(event.runId) == self.id:
            if event.exception:
                now = datetime.datetime.now()
                self._row(now, now, 0, "ERROR", event.exception.splitlines()[0][:500], {}, None)
            self.done.set()


def apply_stream(changes: DataFrame, target: Target, checkpoint: str, name: str = "changes", interval: str | None = None, log_path: str | None = None) -> StreamingQuery:
    """Merge a stream of change records (``_op``, ``_ts``, ``_seq``, columns) into ``target``.

    Each micro-batch commits under its number in the stream that its checkpoint folder belongs to, so one that is replayed after a
    failure changes nothing, and other streams into the same target have numbers of their own. Late
    changes lose against newer rows by their order, so no watermark is needed. ``interval``
    None reads what there is and stops; otherwise the source is looked at every so often. ``log_path``: a run log that gets
    a row for each micro-batch, as ``plans.run`` writes them for its objects; ``finished`` waits for the last of them.
    """
    spark = changes.sparkSession
    stream, query = f"{name}/{stream_id(spark, checkpoint)}", f"{name}-{uuid.uuid4().hex}"
    if log_path:
        from ..plans.run import LOG_SCHEMA

        listener = RunLogListener(spark, query, name, log_path, LOG_SCHEMA)
        spark.streams.addListener(listener)
        changes = changes.observe(query, F.count(F.lit(1)).alias("records"), F.max("_ts").alias("max_ts"))

    def merge(batch: DataFrame, number: int) -> None:
        target.apply(batch, number, stream=stream)

    writer = changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).queryName(query)
    started = (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    if log_path:
        _LISTENERS[str(started.runId)] = listener
    return started


_LISTENERS: dict[str, RunLogListener] = {}


def finished(query: StreamingQuery, seconds: float = 60) -> bool:
    """Wait for a query that ends and for its rows of the run log; whether both came in time. An error of the query is raised."""
    listener = _LISTENERS.pop(str(query.runId), None)
    try:
        ended = query.awaitTermination(int(seconds))
    finally:
        told = listener.done.wait(seconds) if listener else True
        if listener:
            listener.spark.streams.removeListener(listener)
    return bool(ended) and told

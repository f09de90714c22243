"""Progress of streaming queries as a table.

A listener appends one row for each source of each reported micro-batch to a folder, so that what a query has read, how fast, and what
it counted is a table that outlives the query and can be joined with the offsets of a topic.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, name string, batch_id long, at string, source string, start_offset string, end_offset string, "
    "latest_offset string, input_rows long, input_rows_per_second double, processed_rows_per_second double, observed string"
)


class ProgressLog(StreamingQueryListener):
    """Appends each progress report to ``path``; ``attach`` registers it with a session.

    Reports come on the driver, a few for each trigger and a few hundred bytes each; a report gets a file of its own, so nothing is ever rewritten.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    def attach(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        finite = lambda x: x if x is not None and x == x and abs(x) != float("inf") else None
        observed = json.dumps({k: v.asDict() for k, v in (p.observedMetrics or {}).items()}, default=str)
        rows = [dict(
            query_id=str(p.id), run_id=str(p.runId), name=p.name, batch_id=p.batchId, at=p.timestamp, source=s.description,
            start_offset=_text(s.startOffset), end_offset=_text(s.endOffset), latest_offset=_text(s.latestOffset), input_rows=s.numInputRows,
            input_rows_per_second=finite(s.inputRowsPerSecond), processed_rows_per_second=finite(s.processedRowsPerSecond), observed=observed,
        ) for s in p.sources]
        # The number of the source keeps two sources of one description apart.
        text = "".join(json.dumps(r) + "\n" for r in rows)
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.id}-{p.runId}-{p.batchId}-{p.timestamp.replace(':', '')}.json")
        stream = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset)


def wait_for_reports(spark: SparkSession, seconds: float = 30) -> None:
    """Until the reports made so far have reached all listeners."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(int(seconds * 1000))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row for each source of each micro-batch; of several reports of a batch, as after a restart, the last."""
    rows = spark.read.schema(PROGRESS).json(path)
    newest = Window.partitionBy("query_id", "source", "batch_id").orderBy(F.col("at").desc(), F.col("input_rows").desc())
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def rows_read(progress: DataFrame, topic: str) -> DataFrame:
    """(topic, partition, group_id, committed): rows each query has read of sources without topic partitions, such as a folder."""
    return progress.groupBy(F.coalesce("name", "query_id").alias("group_id")).agg(F.sum("input_rows").alias("committed")).select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), "group_id", "committed")


def offsets_read(progress: DataFrame, column: str = "end_offset", out: str = "committed") -> DataFrame:
    """(topic, partition, group_id, <out>) of the newest report of each query on a Kafka topic, whose offsets are maps by partition.

    ``latest_offset`` gives the ends of the topic as the query last saw them.
    """
    last = progress.groupBy(F.coalesce("name", "query_id").alias("group_id"), "source").agg(F.max_by(column, "batch_id").alias("text"))
    per_topic = last.select("group_id", F.explode(F.from_json("text", "map<string,map<string,bigint>>")).alias("topic", "p"))
    return per_topic.select("topic", F.explode("p").alias("partition", out), "group_id").select(
        "topic", F.col("partition").cast("int").alias("partition"), "group_id", out)


def folder_ends(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """(topic, partition, begin_offset, end_offset) of a folder of message lines that stands in for a topic of one partition."""
    return spark.read.option("recursiveFileLookup", True).text(path).agg(F.count(F.lit(1)).alias("end_offset")).select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("begin_offset"), "end_offset")

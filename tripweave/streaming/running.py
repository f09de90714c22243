"""The running mean error of each arrival, kept on the stream.

Arrivals are keyed, by topic partition for example, as order is a matter of one partition. State of a key is two numbers, how
many arrivals it has had and the sum of their errors, and the arrivals of the batch that is not yet full; batches
of a fixed number leave when they are full, and a timer sends the last, partial one when nothing more comes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tripweave import settings as S
from tripweave.streaming.speed_layer import _triggered

#: What a stateful query returns for each arrival; keys are texts.
TRACKED = "key string, id string, processed long, avg_error double, batch_id long"


class RunningError(StatefulProcessor):
    """Numbers the arrivals of a key and follows their mean error; full batches leave at once, the rest by timer."""

    def __init__(self, size: int, flush_ms: int):
        self.size, self.flush_ms = size, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "processed long, total double")
        self.waiting = handle.getListState("waiting", "id string, processed long, avg_error double")
        self.timer = handle.getValueState("timer", "at long")

    def _set_timer(self, at: int | None) -> None:
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
            self.timer.clear()
        if at is not None:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The rows come in order, some thousands at a time; no more than that and a partial batch is held.
        done, total = self.totals.get() if self.totals.exists() else (0, 0.0)
        held = list(self.waiting.get()) if self.waiting.exists() else []
        for arrived in rows:
            errors = arrived["prediction_error"].astype("float64").fillna(0.0).to_numpy()
            sums = np.cumsum(np.concatenate([[total], errors]))[1:]
            processed = done + np.arange(1, len(arrived) + 1)
            done, total = int(processed[-1]), float(sums[-1])
            held += list(zip(arrived["id"].tolist(), processed.tolist(), (sums / processed).tolist()))
            full = len(held) - done % self.size
            if full > 0:
                yield self._out(key, held[:full])
                held = held[full:]
        self.totals.update((done, total))
        if held:
            self.waiting.put([tuple(x) for x in held])
        else:
            self.waiting.clear()
        self._set_timer(timerValues.getCurrentProcessingTimeInMs() + self.flush_ms if held else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = list(self.waiting.get()) if self.waiting.exists() else []
        self.waiting.clear()
        self.timer.clear()
        if held:
            yield self._out(key, held)

    def _out(self, key, held: list) -> pd.DataFrame:
        ids, processed, means = zip(*held)
        return pd.DataFrame({"key": key[0], "id": ids, "processed": processed, "avg_error": means,
                             "batch_id": (np.array(processed) - 1) // self.size})

    def close(self) -> None:
        pass


def running_error(scored: DataFrame, key: str, order: list[str], size: int = S.CONSUMER_BATCH, flush_ms: int = 10_000) -> DataFrame:
    """(key, id, processed, avg_error, batch_id) of a stream of scored trips, keyed by ``key``.

    An arrival without a prediction adds 0, as in the batch form. Rows of one micro-batch count in the order of ``order``; earlier micro-batches
    come first. After ``flush_ms`` without arrivals a partial batch leaves; arrivals after it go on in the same numbers.
    """
    keyed = scored.select(F.col(key).cast("string").alias("key"), *dict.fromkeys(["id", "prediction_error", *order]))
    # Spark sorts the rows of a micro-batch, on disk if need be; the stateful step takes them in that order and asks for no other.
    arriving = keyed.repartition("key").sortWithinPartitions("key", *[F.col(c).asc_nulls_last() for c in order])
    return arriving.groupBy("key").transformWithStateInPandas(
        RunningError(size, flush_ms), StructType.fromDDL(TRACKED), "Append", "ProcessingTime")


def start_running_error(
    scored: DataFrame, out: str, checkpoint: str, key: str, order: list[str], size: int = S.CONSUMER_BATCH, flush_ms: int = 10_000,
    trigger: str | None = S.TRIGGER,
) -> StreamingQuery:
    """Append the figures as Parquet, exactly once.

    Timers of processing time keep a query in motion: with a trigger, runs without new messages fire them. With ``trigger=None`` the query
    handles what is there and stops, so a partial batch waits in the state for the next run.
    """
    spark = scored.sparkSession
    # The check refuses every sort of a stream; this one is within a micro-batch.
    needed = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE,
              "spark.sql.streaming.unsupportedOperationCheck": "false",
              "spark.sql.streaming.noDataMicroBatches.enabled": "true" if trigger else "false"}
    before = {name: spark.conf.get(name) for name in needed}
    writer = running_error(scored, key, order, size, flush_ms).writeStream.outputMode("append").format("parquet").option(
        "path", out).option("checkpointLocation", checkpoint)
    # A query keeps the settings it starts with.
    try:
        for name, value in needed.items():
            spark.conf.set(name, value)
        return _triggered(writer, trigger).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

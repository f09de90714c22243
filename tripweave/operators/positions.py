"""Row positions and running sums over a total order, without a one-task window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripweave.session import materialize


#: Bytes of input that one partition of the sort should get.
_SORT_BYTES = 64 << 20


def _sort_partitions(df: DataFrame) -> int:
    """Partitions for a sort of ``df``: the session's, or more where the optimizer knows the input to be larger."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A plan without statistics reports an absurd size; beyond a few hundred thousand tasks the driver is the limit.
    return max(session, min(known // _SORT_BYTES, 200_000)) if known < 1 << 60 else session


def _numbered(rows: DataFrame, names: list[str]) -> DataFrame:
    """``_row`` and the running sums of ``names`` within each sorted partition, as its batches pass."""
    def number(batches):
        seen, sums = 0, dict.fromkeys(names, 0)
        for batch in batches:
            n = batch.num_rows
            columns = list(batch.columns)
            for name in names:
                at = batch.schema.get_field_index(name)
                values = np.nan_to_num(batch.column(at).to_numpy(zero_copy_only=False).astype("float64"), nan=0.0)
                run = np.cumsum(np.concatenate([[sums[name]], values]))[1:]
                sums[name] = run[-1] if n else sums[name]
                columns[at] = pa.array(run)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(seen, seen + n))], [*batch.schema.names, "_row"])
            seen += n

    return rows.mapInArrow(number, StructType([*rows.schema.fields, StructField("_row", LongType())]))


def with_positions(
    df: DataFrame,
    order: list[str],
    index: str = "row_index",
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row under ``order``, and running sums (as doubles) along it.

    The rows are range-sorted once, in as many partitions as their size asks for; place and running sums within a partition are counted as
    its rows pass, and the result is written, so all reads below see one fixed layout and nothing is shuffled or sorted again.
    One row per partition, what lies before it, is broadcast. A tie-breaker lets the range split copies of a row.
    ``release`` of the session gives the written rows up.
    """
    running = running or {}
    tied = df.withColumns({f"_sum_{n}": e.cast("double") for n, e in running.items()} | {"_tie": F.monotonically_increasing_id()})
    keys = [*order, "_tie"]
    ordered = tied.repartitionByRange(_sort_partitions(df), *keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_part", F.spark_partition_id())
    placed = materialize(_numbered(ordered, [f"_sum_{n}" for n in running]))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max_by(F.struct("_row", *[f"_sum_{n}" for n in running]), "_row")
    sizes = placed.groupBy("_part").agg(last.alias("x"))
    starts = sizes.select("_part", F.coalesce(F.sum(F.col("x._row") + 1).over(before), F.lit(0)).alias("_first"),
                          *[F.coalesce(F.sum(F.col(f"x._sum_{n}")).over(before), F.lit(0.0)).alias(f"_b_{n}") for n in running])
    joined = placed.join(F.broadcast(starts), "_part").withColumn(index, F.col("_first") + F.col("_row"))
    joined = joined.withColumns({n: F.col(f"_b_{n}") + F.col(f"_sum_{n}") for n in running}) if running else joined
    return joined.select(*df.columns, index, *running)


def slice_by_position(df: DataFrame, order: list[str], start: int, stop: int) -> DataFrame:
    """Rows [start, stop) under ``order``. Only ``stop`` rows survive each task's top-k."""
    head = df.orderBy(*order).limit(stop)
    place = F.row_number().over(Window.orderBy(*order))
    return head.withColumn("_place", place).filter(F.col("_place") > start).drop("_place")


def replay_bounds(rows: int, hour: int, size: int) -> tuple[int, int]:
    """The slice replayed in ``hour``; fewer rows than one slice are replayed whole."""
    slices = max(rows // size, 1)
    start = hour % slices * size
    return start, start + size

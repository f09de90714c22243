"""One-row frames as columns, so that pairing a table with a summary needs no join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def the_row(frame: DataFrame) -> Column:
    """The single row of ``frame`` as a struct, null if it has none.

    It is a scalar subquery: Spark computes it once and every task sees it as a constant.
    """
    return frame.select(F.struct(*frame.columns).alias("row")).scalar()


def side_by_side(frames: dict[str, DataFrame]) -> DataFrame:
    """One row with one struct column per one-row frame."""
    first = next(iter(frames.values()))
    return first.sparkSession.range(1).select(*[the_row(frame).alias(name) for name, frame in frames.items()])


def taken(frame: DataFrame) -> DataFrame:
    """A one-row frame computed now and kept as its row; later uses do not compute it again."""
    return frame.sparkSession.createDataFrame([frame.first()], frame.schema)

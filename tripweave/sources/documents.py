"""One-row JSON documents: reports, alerts, metrics and dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_document(row: DataFrame) -> DataFrame:
    """Any one-row frame as a single JSON text."""
    packed = F.to_json(F.struct(*row.columns), {"ignoreNullFields": "false"})
    return row.select(packed.alias("document"))


def write_document(document: DataFrame, path: str) -> str:
    """Write the ``document`` column; the frame holds one short row."""
    document.select("document").coalesce(1).write.mode("overwrite").text(path)
    return path

"""Speed-layer output: JSON lines, one folder per micro-batch.

The speed layer stores its batches behind a manifest (``batch_store``), which then says what is read. Folders without one, as
other writers leave them, hold ``batch_id=<00000>`` folders; only these are read, so other documents in
the folder are not taken for data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave import settings as S
from tripweave.schemas import SPEED_SCHEMA
from tripweave.sources.batch_store import Batch, BatchStore
from tripweave.sources.json_rows import is_record, not_blank, parsed_lines, typed

_BATCH_IN_PATH = r"batch_id=(\d+)"
_BATCH_IN_STORE = r"/batches/(?:many-[0-9a-f]+/batch_id=)?0*(\d+)"
_ROW = StructType([f for f in SPEED_SCHEMA.fields if f.name != "batch_id"])


def batch_folder(base: str, batch_id: int) -> str:
    return f"{base}/batch_id={batch_id:05d}"


def write_batch(rows: DataFrame, base: str, batch_id: int) -> str:
    """One micro-batch without a manifest; the id is kept in the folder name."""
    path = batch_folder(base, batch_id)
    rows.drop("batch_id").write.mode("overwrite").json(path)
    return path


def store_batch(rows: DataFrame, base: str, batch_id: int, written: str, **counted: Column) -> Batch:
    """One micro-batch behind the manifest. Its row count, newest row and the ``counted`` facts come from the pass that writes it."""
    store, seen = BatchStore(rows.sparkSession, base), Observation()
    counting = [F.count(F.lit(1)).alias("records"), F.max("processed_time").alias("newest"), *[e.alias(n) for n, e in counted.items()]]
    folder = store.stage(rows.observe(seen, *counting), batch_id)
    facts = dict(seen.get)
    batch = Batch(batch_id, folder, facts.pop("records"), written, facts.pop("newest"), facts)
    store.commit(batch)
    return batch


def write_batches(rows: DataFrame, base: str) -> str:
    """Many batches at once, by their ``batch_id``."""
    name = F.lpad(F.col("batch_id").cast("string"), 5, "0")
    rows.withColumn("batch_id", name).write.mode("append").partitionBy("batch_id").json(base)
    return base


def _lines(spark: SparkSession, base: str, batch_ids: list[int] | None, ignore_missing: bool) -> DataFrame:
    store = BatchStore(spark, base)
    reader = spark.read.options(ignoreMissingFiles=ignore_missing)
    if store.exists():
        live = store.snapshot().batches
        held = [live[i] for i in (sorted(live) if batch_ids is None else batch_ids) if i in live]
        if not held:
            lines = spark.createDataFrame([], "value string, batch_id int")
        else:
            number = F.regexp_extract(F.col("_metadata.file_path"), _BATCH_IN_STORE, 1).cast("int")
            lines = reader.text(store.paths(held)).select("value", number.alias("batch_id"))
        return parsed_lines(lines, F.col("value"), _ROW, F.col("batch_id"))
    folders = [f"{base}/batch_id=*"] if batch_ids is None else [batch_folder(base, i) for i in batch_ids]
    lines = reader.option("basePath", base).text(folders)
    return parsed_lines(lines, F.col("value"), _ROW, F.col("batch_id").cast("int").alias("batch_id"))


def read_batches(spark: SparkSession, base: str, batch_id: int | None = None, ignore_missing: bool = False) -> DataFrame:
    """All rows, or those of one batch, with ``batch_id`` taken from the folder.

    A line is a row if every field of it has its type, whichever columns a query asks for; ``read_rejects`` has the others.
    ``ignore_missing`` passes over files that retention removes between listing and reading; without it that is an error.
    """
    return _rows(spark, base, None if batch_id is None else [batch_id], ignore_missing)


def _rows(spark: SparkSession, base: str, batch_ids: list[int] | None, ignore_missing: bool = False) -> DataFrame:
    rows = _lines(spark, base, batch_ids, ignore_missing).filter(is_record(_ROW))
    return rows.select(*typed(_ROW), "batch_id").select(*SPEED_SCHEMA.fieldNames())


def read_rejects(spark: SparkSession, base: str, batch_id: int | None = None) -> DataFrame:
    """(batch_id, value) of the lines that are not blank and no rows."""
    return _lines(spark, base, None if batch_id is None else [batch_id], False).filter(~is_record(_ROW)).select("batch_id", "value")


def files(spark: SparkSession, base: str) -> DataFrame:
    """(path, batch_id, modified, length) of the data files, from the listing alone."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base}/batch_id=*")
    return listing.select(
        "path", F.regexp_extract("path", _BATCH_IN_PATH, 1).cast("int").alias("batch_id"),
        F.col("modificationTime").alias("modified"), "length",
    )


def recent_batch_ids(spark: SparkSession, base: str, n: int = S.RECENT_FILES, by: str = "batch_id") -> list[int]:
    """The newest ``n`` batches, by number or by the time they were ``modified``; a manifest answers without any listing."""
    store = BatchStore(spark, base)
    if store.exists():
        return [b.batch_id for b in store.snapshot().newest(n, "batch_id" if by == "batch_id" else "written")]
    newest = (
        files(spark, base).groupBy("batch_id").agg(F.max("modified").alias("modified"))
        .orderBy(F.col(by).desc(), F.col("batch_id").desc()).limit(n)
    )
    return [row.batch_id for row in newest.collect()]


def read_recent(spark: SparkSession, bases: list[str], n: int = S.RECENT_FILES, by: str = "batch_id") -> DataFrame:
    """The newest ``n`` batches of each folder, united by column name; only their files are opened."""
    return union_all([_rows(spark, base, recent_batch_ids(spark, base, n, by)) for base in bases])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenation of frames whose columns may differ; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def inventory(spark: SparkSession, base: str) -> DataFrame:
    """(name, records, modified) per batch folder, counting non-blank lines; of a manifest, what was counted while writing."""
    store = BatchStore(spark, base)
    if store.exists():
        return store.counts().select(
            F.format_string("batch_id=%05d", "batch_id").alias("name"), "records", F.col("written").try_cast("timestamp").alias("modified"))
    meta = F.col("_metadata")
    lines = (
        spark.read.option("recursiveFileLookup", True).text(f"{base}/batch_id=*")
        .select(
            "value",
            F.regexp_extract(meta["file_path"], _BATCH_IN_PATH, 0).alias("name"),
            meta["file_modification_time"].alias("modified"),
        )
    )
    return lines.filter(not_blank(F.col("value"))).groupBy("name").agg(
        F.count(F.lit(1)).alias("records"), F.max("modified").alias("modified")
    )

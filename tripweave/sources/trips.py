"""Raw and cleaned trip files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripweave.schemas import REQUIRED_COLUMNS, TRIP_SCHEMA


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path, or a glob, matches something on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(target))


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first path that exists: the full source, else its fallback, else an error."""
    for path in paths:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")


def header_columns(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_trips_csv(spark: SparkSession, *paths: str, schema: StructType = TRIP_SCHEMA) -> DataFrame:
    """Trips from CSV with a header, typed by name from the contract instead of by inference.

    Only the header is looked at first: optional columns may be absent, required ones may not.
    """
    path = first_existing(spark, list(paths))
    present = header_columns(spark, path)
    missing = [c for c in REQUIRED_COLUMNS if c not in present]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    types = {f.name: f for f in schema.fields}
    layout = StructType()
    for name in present:
        layout = layout.add(types[name]) if name in types else layout.add(name, "string")
    return (
        spark.read.schema(layout)
        .options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS]", enforceSchema=False)
        .csv(path)
    )


def read_trips_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(first_existing(spark, list(paths)))


def write_trips(trips: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write trips. Parquet is what the views should read; CSV is for exchange."""
    options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"} if fmt == "csv" else {}
    trips.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def publish(spark: SparkSession, staged: str, path: str) -> str:
    """Move a staged folder to its place, in place of what is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at, True)
    fs.mkdirs(at.getParent())
    if not fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged), at):
        raise OSError(f"{staged} could not be moved to {path}")
    return path


def discard(spark: SparkSession, staged: str) -> None:
    """Delete a staged folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

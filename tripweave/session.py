"""Session builder, shared storage and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tripweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on; keyword ``a__b`` sets ``a.b``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # The JVM interprets methods above this size; plain operators are faster than that.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripweave-"))
    return sc.getCheckpointDir()


#: Folders that ``materialize`` wrote for each application, until ``release``.
_WRITTEN: dict[str, list[str]] = {}


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> int:
    """Delete what ``materialize`` wrote so far in this application; frames built on it must not be used afterwards."""
    sc = spark.sparkContext
    paths = _WRITTEN.pop(sc.applicationId, [])
    for path in paths:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    This cuts the lineage: a lost executor cannot change what was computed once, and later reads
    fetch only the columns they need. ``release`` deletes the rows.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "rows")
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

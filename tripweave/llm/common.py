"""What the text operators share: white space, tables, row identity, released intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.session import fresh_dir

#: The white space that separates words, as characters and as a pattern.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def packed(docs: DataFrame, **named: Column) -> DataFrame:
    """The named columns beside ``row``, which holds all columns of ``docs`` untouched.

    Extra columns of the input, whatever their names, cannot clash with what an operator adds.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[c.alias(name) for name, c in named.items()])


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


class Scratch:
    """Tables in the shared folders that one operator run writes and gives up again."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self.paths: list[str] = []
        self.tables: list[str] = []

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write the rows to the shared folder and read them back, which also cuts the lineage."""
        path = fresh_dir(self.spark, f"{self.label}-{name}")
        df.write.options(**options).parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """A table bucketed by ``key``, so that joins on it need not move its rows."""
        full = f"{self.label}_{name}_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, key).format("parquet").saveAsTable(full)
        self.tables.append(full)
        return self.spark.table(full)

    def release(self, *names: str) -> None:
        """Delete what was kept under these names, or all of it."""
        sc = self.spark.sparkContext
        for path in list(self.paths):
            if not names or any(f"{self.label}-{n}-" in path for n in names):
                where = sc._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
                self.paths.remove(path)
        for full in list(self.tables):
            if not names or any(full.startswith(f"{self.label}_{n}_") for n in names):
                self.spark.sql(f"DROP TABLE IF EXISTS {full}")
                self.tables.remove(full)


def apart(docs: DataFrame, *extra: Column) -> DataFrame:
    """``row`` with all columns but the text, and ``text`` beside it, so that the text moves once only."""
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    return docs.select(row, F.col("text").cast("string").alias("text"), *extra)


def beside_row(rows: DataFrame, ddl: str) -> T.StructType:
    """A schema of ``row`` as ``rows`` has it and the columns of ``ddl``; ``row`` may hold any names."""
    return T.StructType([rows.schema["row"], *T.StructType.fromDDL(ddl).fields])


def together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in their order, from ``row`` and ``text``."""
    return rows.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def partitions_for(spark: SparkSession, size: int, each: int) -> int:
    """Enough partitions that none holds more than about ``each`` of ``size``; never fewer than the session's own."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


#: Rows of numbers that may be broadcast; 8 to 32 bytes a row.
BROADCAST_ROWS = 1 << 20


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast if the counted rows are few enough, else left to a shuffled join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df

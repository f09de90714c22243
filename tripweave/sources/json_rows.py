"""JSON lines read with the whole schema at once, so that what counts as a record never depends on the columns asked for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType
_CORRUPT = "_unreadable"
_LARGEST_INT = float((1 << 31) - 1)


def not_blank(text: Column) -> Column:
    """Whether there is anything but white space."""
    return text.rlike(r"\S")


def parsed_lines(lines: DataFrame, text: Column, schema: StructType, *carried: Column) -> DataFrame:
    """The carried columns, ``value`` and ``data`` of the lines that are not blank, each parsed once.

    Writers that hold an int column with gaps as numbers put ``1.0`` for 1, so ints are read as doubles first.
    """
    wide = StructType()
    for field in schema.fields:
        wide = wide.add(field.name, DoubleType() if isinstance(field.dataType, IntegerType) else field.dataType)
    data = F.from_json(text, wide.add(_CORRUPT, "string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # The generator keeps later filters on parsed columns from repeating the parse; those on carried columns go through it.
    return lines.filter(not_blank(text)).select(*carried, F.inline(F.array(F.struct(text.alias("value"), data.alias("data")))))


def is_record(schema: StructType) -> Column:
    """Whether a parsed line has the types of the schema; a number with a fraction is no int."""
    whole = [
        F.col(f"data.{f.name}").isNull() | ((F.floor(F.col(f"data.{f.name}")) == F.col(f"data.{f.name}")) & (F.abs(F.col(f"data.{f.name}")) <= _LARGEST_INT))
        for f in schema.fields if isinstance(f.dataType, IntegerType)
    ]
    return reduce(lambda a, b: a & b, whole, F.col("data").isNotNull() & F.col(f"data.{_CORRUPT}").isNull())


def typed(schema: StructType) -> list[Column]:
    return [F.col(f"data.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields]

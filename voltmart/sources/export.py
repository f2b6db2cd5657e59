"""CSV export of mart tables in the warehouse's text form."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.functions.text import csv_columns


def export_name(schema: str, table: str, as_of: str) -> str:
    """``<schema>_<table>_<UTC stamp>.csv`` for an ISO ``as_of`` in UTC."""
    digits = "".join(ch for ch in as_of.split(".")[0] if ch.isdigit())
    return f"{schema}_{table}_{digits[:8]}T{digits[8:14].ljust(6, '0')}Z.csv"


def export_csv(df: DataFrame, folder: str) -> str:
    """Write all rows as text columns with a header, one file per task.

    NULL becomes an empty field and an empty text becomes ``""``, so both survive. A table
    without rows still gets a header: its single empty partition is written like any other. The
    export is written beside ``folder`` and takes its place when it is whole, so it can be repeated.
    """
    text = df.select(*csv_columns(df))
    staged = f"{folder}.{uuid.uuid4().hex[:12]}"
    text.write.mode("errorifexists").option("header", True).option("nullValue", "").option(
        "emptyValue", '""'
    ).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(staged)
    _replace(df.sparkSession, staged, folder)
    return folder


def _replace(spark: SparkSession, staged: str, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(folder), True)
    if not files.rename(path(staged), path(folder)):
        raise OSError(f"could not rename {staged} to {folder}")


def read_export(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """Read an export back as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
        .option("nullValue", "").option("multiLine", False).csv(folder)
    )


def parse_export(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns of an export back to the table's types."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = c == "t"
        elif isinstance(f.dataType, T.TimestampType):
            # The text ends in a bare hour offset (+00).
            c = F.concat(c, F.lit(":00")).cast("timestamp")
        cols.append(c.cast(f.dataType).alias(f.name))
    return text.select(*cols)

"""Full-load extraction into the raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from voltmart.functions.time import as_ts
from voltmart.schemas import INGESTED_AT, TableSpec


def discover_columns(df: DataFrame) -> list[str]:
    """Column names in ordinal order (A3)."""
    return list(df.columns)


def common_columns(source: DataFrame, target: T.StructType, label: str = "source") -> list[str]:
    """Shared columns in source order, technical columns left out (A2)."""
    wanted = set(target.names)
    shared = [c for c in source.columns if c in wanted and not c.startswith("_")]
    if not shared:
        raise ValueError(f"no common columns between {label} and the target table")
    return shared


def full_load(source: DataFrame, target: T.StructType, run_ts) -> DataFrame:
    """The rows that replace the target: shared columns plus the load stamp (A1).

    Casting to the target types happens here, at the boundary, so later layers never cast.
    """
    shared = common_columns(source, target)
    out = source.select(*[F.col(c).cast(target[c].dataType).alias(c) for c in shared])
    if INGESTED_AT in target.names:
        out = out.withColumn(INGESTED_AT, as_ts(run_ts))
    return out


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select by name in schema order; columns the source lacks become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def load_report(spec: TableSpec, loaded: DataFrame) -> DataFrame:
    """Source, target, rows and columns of one load, as a one-row frame."""
    columns = [c for c in loaded.columns if not c.startswith("_")]
    return loaded.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
        F.lit(f"public.{spec.name}").alias("source"),
        F.lit(f"{spec.raw_layer}.{spec.name}").alias("target"),
        "rows_loaded",
        F.lit(",".join(columns)).alias("columns"),
    )


def column_fill(source: DataFrame, target: T.StructType, label: str) -> DataFrame:
    """Per shared column: position in the source and number of filled rows (A2, A3).

    One pass over the source whatever the number of columns.
    """
    shared = common_columns(source, target, label)
    counts = source.agg(*[F.count(F.col(c)).alias(c) for c in shared])
    positions = {c: i for i, c in enumerate(discover_columns(source), start=1)}
    pairs = ", ".join(f"{positions[c]}, '{c}', `{c}`" for c in shared)
    return counts.selectExpr(f"stack({len(shared)}, {pairs}) AS (ordinal, column_name, filled_rows)").select(
        F.lit(label).alias("table_name"), "ordinal", "column_name", "filled_rows"
    )


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or its typed empty form when it does not exist yet."""
    try:
        return conform(spark.read.parquet(path), schema)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], schema)
        raise


def jdbc_options(
    url: str,
    table: str,
    columns: list[str] | None = None,
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 32,
    fetch_rows: int = 20_000,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``: batched fetch and a range-split read.

    Without a split column one task reads the table, so large tables must name one.
    """
    source = table if columns is None else f"(SELECT {', '.join(columns)} FROM {table}) AS src"
    options = {"url": url, "dbtable": source, "fetchsize": str(fetch_rows)}
    if split_column:
        if bounds is None:
            raise ValueError("a split column needs lower and upper bounds")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A source table over JDBC, with filters and columns pushed into the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()

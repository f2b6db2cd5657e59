"""Constraint reports: the checks a database would enforce on write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(df: DataFrame, key: str, label: str) -> DataFrame:
    """Keys that occur more than once, with their row count.

    The count combines before the shuffle, so one key with very many copies stays cheap.
    """
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .select(F.lit(label).alias("table_name"), F.col(key).cast("string").alias("key_value"), "copies")
    )


def column_constraints(df: DataFrame, schema: T.StructType, max_len: dict[str, int], label: str) -> DataFrame:
    """NULLs in required columns and values over their length limit, one row per column.

    A single aggregation pass feeds all columns; ``stack`` turns it into rows.
    """
    aggs, parts = [], []
    fields = [f for f in schema.fields if not f.name.startswith("_")]
    for f in fields:
        nulls = F.count_if(F.col(f.name).isNull()) if not f.nullable else F.lit(0).cast("bigint")
        aggs.append(nulls.alias(f"n_{f.name}"))
        limit = max_len.get(f.name)
        if limit:
            aggs.append(F.count_if(F.length(f.name) > limit).alias(f"o_{f.name}"))
            aggs.append(F.max(F.length(f.name)).alias(f"m_{f.name}"))
            parts.append(f"'{f.name}', n_{f.name}, o_{f.name}, m_{f.name}")
        else:
            parts.append(f"'{f.name}', n_{f.name}, CAST(0 AS BIGINT), CAST(NULL AS INT)")
    rows = f"stack({len(parts)}, {', '.join(parts)}) AS (column_name, null_rows, over_limit_rows, longest)"
    return df.agg(*aggs).selectExpr(rows).select(F.lit(label).alias("table_name"), "*")

"""Registration of queries under the survey's operator ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmart.session import configure
from voltmart.sources.testviews import TestViews

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as double, so both engines hash the same values."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string").alias(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double").alias(field.name)
        out.append(c)
    return df.select(*out)


def query(name: str, oracle: str | None = None):
    """Register ``fn(views) -> DataFrame`` and, where SQL can say it, its DuckDB twin."""

    def register(fn: Callable[[TestViews], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(TestViews(configure(spark), sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register

"""CORE layer: typed copies of raw tables, each from its one source of truth."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltmart.schemas import TABLES
from voltmart.sources.extract import conform


def source_of_truth(table: str) -> str:
    """The raw layer a core table is read from; debts and payments come from billing only."""
    return TABLES[table].raw_layer


def core_table(table: str, raw: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """``core.<table>`` from ``raw[layer][table]``, columns by position of the shared schema."""
    return conform(raw[source_of_truth(table)][table], TABLES[table].schema)


def core_layer(raw: dict[str, dict[str, DataFrame]]) -> dict[str, DataFrame]:
    return {table: core_table(table, raw) for table in TABLES}

"""Changes of a table whose bookmark cannot be trusted (F2).

An ended rental keeps its start time and a deleted row leaves nothing to find. So rows are
digested per range, the digests of two states are compared range by range, and only ranges that
differ are read in full and compared row by row under their key.

A range is a day of the table's time column and one of a few hash tokens of the key: the day can be
pushed into scans, the tokens cut a day that very many rows share. A row that changes its time leaves
one range and enters another, so both differ and the row is met on both sides of the comparison.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE = ["range_day", "range_token"]
TOKENS = 16
# Spans of days given to a scan; days between near spans are read as well when there are more.
MAX_SPANS = 32
NO_DAY = "0001-01-01"
OPS = ("insert", "update", "delete")


def range_of(key: str, ts: str, tokens: int = TOKENS) -> list[Column]:
    """The range of a row; rows without a time share the days of NO_DAY."""
    day = F.coalesce(F.to_date(F.col(ts)), F.lit(NO_DAY).cast("date"))
    return [day.alias(RANGE[0]), F.pmod(F.xxhash64(key), F.lit(tokens)).cast("int").alias(RANGE[1])]


def _row_hash(columns: list[str], seed: int) -> Column:
    # The hash skips nulls, so each value goes with a flag that says whether there is one.
    flagged = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(F.lit(seed), *flagged)


def range_digests(df: DataFrame, key: str, ts: str, columns: list[str], tokens: int = TOKENS) -> DataFrame:
    """Per range: rows, and sums of two 64-bit row hashes in halves (``digest``).

    Sums do not depend on the order of rows, tell repeated rows apart, combine before the shuffle and
    cannot overflow below 2^31 rows a range. The result has days x tokens rows.
    """
    hashes = df.select(*range_of(key, ts, tokens), *[_row_hash(columns, s).alias(f"_h{s}") for s in (0, 1)])
    half = F.lit(0xFFFFFFFF)
    sums = [F.sum(part) for s in (0, 1) for part in (F.col(f"_h{s}").bitwiseAND(half), F.shiftrightunsigned(f"_h{s}", 32))]
    return hashes.groupBy(*RANGE).agg(F.count(F.lit(1)).alias("range_rows"), F.array(*sums).alias("digest"))


def compared_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """Every range of either state: rows_before, rows_after, changed."""
    old = before.select(*RANGE, F.col("range_rows").alias("rows_before"), F.col("digest").alias("_old"))
    new = after.select(*RANGE, F.col("range_rows").alias("rows_after"), F.col("digest").alias("_new"))
    return old.join(new, RANGE, "full_outer").select(
        *RANGE,
        F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
        F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        (~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed"),
    )


def spans_of(days: list[dt.date], most: int = MAX_SPANS) -> list[tuple[dt.date, dt.date]]:
    """At most ``most`` spans of days that cover the given ones, apart at the widest gaps."""
    ordered = sorted(set(days))
    if not ordered:
        return []
    gaps = sorted(range(1, len(ordered)), key=lambda i: ordered[i] - ordered[i - 1], reverse=True)
    cuts = sorted(i for i in gaps[: most - 1] if ordered[i] - ordered[i - 1] > dt.timedelta(days=1))
    starts = [0, *cuts]
    ends = [*cuts, len(ordered)]
    return [(ordered[a], ordered[b - 1]) for a, b in zip(starts, ends)]


def in_spans(ts: str, days: list[dt.date]) -> Column:
    """A filter on the time column alone, which scans take as it is."""
    none = dt.date.fromisoformat(NO_DAY)
    out = F.col(ts).isNull() if none in days else F.lit(False)
    for first, last in spans_of([d for d in days if d != none]):
        start, end = F.lit(str(first)).cast("timestamp"), F.lit(str(last + dt.timedelta(days=1))).cast("timestamp")
        out = out | ((F.col(ts) >= start) & (F.col(ts) < end))
    return out


def rows_in(df: DataFrame, ranges: DataFrame, days: list[dt.date], key: str, ts: str, tokens: int = TOKENS) -> DataFrame:
    """The rows of the given ranges; ``days`` are the days of these ranges and prune the scan."""
    wanted = ranges.select(*RANGE)
    day, token = range_of(key, ts, tokens)
    return df.filter(in_spans(ts, days)).withColumns({RANGE[0]: day, RANGE[1]: token}).join(wanted, RANGE, "left_semi").drop(*RANGE)


def keyed_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """op (insert, update or delete), key, before and after (rows as structs) of rows that differ.

    Nulls are values here: a null that becomes a value is an update. Keys must be unique in each
    state (A7 reports those that are not).
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.struct(*columns).alias(name))

    both = side(before, "before").join(side(after, "after"), "key", "full_outer")
    op = F.when(F.col("before").isNull(), OPS[0]).when(F.col("after").isNull(), OPS[2]).otherwise(OPS[1])
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).select(op.alias("op"), "key", "before", "after")


def applied(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table after the changes; at most one change per key. The table is not sorted or aggregated."""
    keys = changes.select(F.col("key").alias("_key"))
    kept = table.join(keys, table[key] == F.col("_key"), "left_anti")
    return kept.unionByName(images(changes, "after").select(*table.columns))


def images(changes: DataFrame, side: str) -> DataFrame:
    """The rows that changes take away (``before``) or put in (``after``)."""
    return changes.filter(F.col(side).isNotNull()).select(f"{side}.*")


def last_per_key(changes: DataFrame, run: str) -> DataFrame:
    """The last change of every key over several runs, as if there had been one."""
    newest = F.max_by(F.struct("op", "before", "after"), run).alias("_c")
    return changes.groupBy("key").agg(newest).select("_c.op", "key", "_c.before", "_c.after")

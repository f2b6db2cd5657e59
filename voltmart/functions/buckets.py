"""Fixed-bucket histograms as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltmart.functions.time import col

# Bucket bounds in seconds.
RENTAL_DURATION_BOUNDS = [60, 300, 900, 1800, 3600, 7200, 14400, 28800, 86400]
API_DURATION_BOUNDS = [0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
DB_QUERY_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
BILLING_CYCLE_BOUNDS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0]


def bucket_names(bounds: list[float]) -> list[str]:
    return [f"le_{i}" for i in range(len(bounds))] + ["le_inf"]


def cumulative_counts(value: Column | str, bounds: list[float]) -> list[Column]:
    """One conditional count per bound plus ``+Inf``; all combine before the shuffle."""
    v = col(value)
    names = bucket_names(bounds)
    counts = [F.count_if(v <= F.lit(b)).alias(n) for b, n in zip(bounds, names)]
    return [*counts, F.count(v).alias(names[-1])]


def bucket_quantile(q: float, cumulative: Column, bounds: list[float]) -> Column:
    """Quantile from an array of cumulative counts (last entry = ``+Inf``).

    Linear inside the bucket that holds rank ``q * total``; the highest finite bound if that
    bucket is ``+Inf``; NULL when the histogram is empty. The first bucket starts at 0.
    """
    total = F.element_at(cumulative, -1)
    rank = F.lit(q) * total
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    # Position (1-based) of the first bucket whose cumulative count reaches the rank.
    position = F.size(F.filter(cumulative, lambda c: c < rank)) + 1
    below = F.when(position > 1, F.get(cumulative, position - 2)).otherwise(F.lit(0))
    inside = F.get(cumulative, position - 1) - below
    lower = F.when(position > 1, F.get(edges, position - 2)).otherwise(F.lit(0.0))
    upper = F.get(edges, position - 1)
    return (
        F.when(total == 0, F.lit(None).cast("double"))
        .when(position > len(bounds), F.lit(float(bounds[-1])))
        .when(inside == 0, upper)
        .otherwise(lower + (upper - lower) * (rank - below) / inside)
    )

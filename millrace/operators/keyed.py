"""Per-key running results that keep whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scan import State, running


def rolling_max_by(
    df: DataFrame, keys: Sequence[str], order: str, value: str, prefix: str = "top_"
) -> DataFrame:
    """For every row, the whole row that holds the largest ``value`` of its key
    so far; the earlier row wins a tie."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    best = F.struct(F.col(value).alias("v"), (-F.col(order)).alias("o"), payload.alias("row"))
    out = running(df, order, {"_best": State(best, "max")}, keys)
    return out.select(
        *df.columns, *[F.col("_best.row").getField(c).alias(prefix + c) for c in df.columns]
    )


def final_max_by(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Only the last state of ``rolling_max_by``: one row per key, no window."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    best = F.max_by(payload, F.struct(F.col(value), -F.col(order)))
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")


def keyed_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))

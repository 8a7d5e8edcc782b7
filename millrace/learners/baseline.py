"""Majority class and last label: exact for every single row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scan import State, count_state, running


def majority_class(
    df: DataFrame,
    order: str,
    label: str,
    classes: Sequence[int],
    keys: Sequence[str] = (),
    name: str = "pred",
    seen: str | None = None,
) -> DataFrame:
    """Most frequent label among the rows before this one (per key), the lowest
    label on a tie, the first class when there is none. ``seen`` names a column
    for the 1-based position of the row, which the same scan yields."""
    counts = [f"_c{c}" for c in classes]
    states = {n: State((F.col(label) == c).cast("bigint")) for n, c in zip(counts, classes)}
    if seen:
        states[seen] = count_state()
    out = running(df, order, states, keys, inclusive=False)
    if seen:
        out = out.withColumn(seen, F.col(seen) + 1)
    best = F.greatest(*counts) if len(counts) > 1 else F.col(counts[0])
    pick = F.coalesce(*[F.when(F.col(n) == best, F.lit(int(c))) for n, c in zip(counts, classes)])
    return out.withColumn(name, pick).drop(*counts)


def no_change(
    df: DataFrame, order: str, label: str, keys: Sequence[str] = (), name: str = "pred"
) -> DataFrame:
    """Label of the row before this one; class 0 for the first."""
    out = running(df, order, {name: State(F.col(label), "last")}, keys, inclusive=False)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("int"))

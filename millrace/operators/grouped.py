"""Grouped Python work for very many groups.

``applyInPandas`` and ``cogroup`` open one Arrow stream per group, which costs
more than the work when groups are small. Here a partition is sorted by its group
columns and read as ordinary batches; complete groups are handed over in bundles.
A group may be spread over batches; one open group and one bundle are held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def _starts(pdf: pd.DataFrame, by: Sequence[str]) -> np.ndarray:
    keys = pdf[list(by)]
    before = keys.shift()
    same = ((keys == before) | (keys.isna() & before.isna())).all(axis=1).to_numpy()
    same[0] = False
    return np.flatnonzero(~same)


def map_sorted_groups(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    work: Callable[[list[pd.DataFrame]], pd.DataFrame],
    schema: str,
    max_groups: int = 64,
    max_rows: int = 1 << 16,
) -> DataFrame:
    """``work`` gets a list of whole groups, each in ``order``, and returns their
    rows. The caller bounds the size of a group (blocks or slices of a key)."""
    by, order = list(by), list(order)
    # an explicit number keeps the adaptive planner from merging partitions by
    # their bytes: the time here goes into Python work per row
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(parts, *by).sortWithinPartitions(*by, *order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        ready: list[pd.DataFrame] = []
        rows = 0
        for pdf in batches:
            if pdf.empty:
                continue
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            starts = _starts(pdf, by)
            for a, b in zip(starts[:-1], starts[1:]):
                ready.append(pdf.iloc[a:b])
                rows += b - a
                if len(ready) >= max_groups or rows >= max_rows:
                    yield work(ready)
                    ready, rows = [], 0
            held = pdf.iloc[starts[-1] :]
        if held is not None:
            ready.append(held)
        if ready:
            yield work(ready)

    return placed.mapInPandas(run, schema)

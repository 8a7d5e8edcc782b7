"""Multi-output linear learner with the delta rule, exact for every row and
parallel over blocks.

The update ``w += lr * (y - x.w) * x`` is affine in ``w``. A chunk of rows with
matrix X therefore acts as one affine map: with the unit lower triangle
``L = I + lr * tril(X X', -1)`` the errors of the whole chunk are
``e = L^-1 (y - X w0)`` and ``w1 = w0 + lr * X' e``. Blocks become pairs (A, b).
Pairs are composed as a tree whose fan-out follows from the size of a pair, so that
no task holds more than ``MAP_BYTES`` of them; start weights go down the same tree,
and every block is replayed from its own. A key whose rows are in one block starts
from the first weights and needs no pair. Nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.grouped import map_sorted_groups
from millrace.runtime import materialise

BLOCK_ROWS = 1 << 13
# Pairs that one task composes: 2000 of 64 features, 450 of 135.
MAP_BYTES = 1 << 26
MAX_FAN_OUT = 1 << 12
_CHUNK = 64


def fan_out(width: int, outputs: int) -> int:
    """Pairs of one node of the tree."""
    size = width + 1
    return max(2, min(MAX_FAN_OUT, MAP_BYTES // (8 * size * (size + outputs))))


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(pdf["_x"].tolist(), dtype=np.float64)
    y = np.array(pdf["_y"].tolist(), dtype=np.float64)
    return np.hstack([x, np.ones((len(x), 1))]), y


def _chunks(x: np.ndarray, y: np.ndarray):
    for at in range(0, len(x), _CHUNK):
        yield x[at : at + _CHUNK], y[at : at + _CHUNK]


def _lower(x: np.ndarray, lr: float) -> np.ndarray:
    return np.eye(len(x)) + lr * np.tril(x @ x.T, -1)


def replayed(w: np.ndarray, x: np.ndarray, y: np.ndarray, lr: float) -> tuple[np.ndarray, np.ndarray]:
    """Predictions of rows in their order from weights ``w`` on, and the weights
    behind them. ``x`` has its column of ones."""
    preds = []
    for part, wanted in _chunks(x, y):
        e = np.linalg.solve(_lower(part, lr), wanted - part @ w)
        preds.append(wanted - e)
        w = w + lr * part.T @ e
    return np.vstack(preds), w


def linear_scan(
    df: DataFrame,
    rank: str,
    features: str,
    targets: str,
    width: int,
    outputs: int,
    lr: float,
    keys: Sequence[str] = (),
    keep: Sequence[str] = (),
    init: float = 0.1,
    block_rows: int = BLOCK_ROWS,
    blocks_per_super: int | None = None,
) -> DataFrame:
    """Prediction for each row before it trains on it. ``rank`` is the position
    per key; the bias is one more weight; every weight starts at ``init``."""
    keys, keep = list(keys), list(keep)
    fan = blocks_per_super or fan_out(width, outputs)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    key_ddl = "".join(f"{k} {fields[k]}, " for k in keys)
    size = width + 1
    passed = [c for c in dict.fromkeys([*keys, rank, *keep])]
    rows = df.select(
        *passed,
        F.col(features).cast("array<double>").alias("_x"),
        F.col(targets).cast("array<double>").alias("_y"),
        F.expr(f"`{rank}` div {int(block_rows)}").alias("_node"),
    )
    map_ddl = "_a array<double>, _b array<double>"

    def told(heads: pd.DataFrame, **columns: list) -> pd.DataFrame:
        return heads.assign(**{c: pd.Series(v, dtype=object) for c, v in columns.items()})

    def as_maps(groups: list[pd.DataFrame]) -> pd.DataFrame:
        # every block has a map, also one with gaps or the last: see starts
        made = []
        for pdf in groups:
            a, b = np.eye(size), np.zeros((size, outputs))
            for x, y in _chunks(*_arrays(pdf)):
                solved = np.linalg.solve(_lower(x, lr), np.hstack([x, y]))
                a -= lr * x.T @ (solved[:, :size] @ a)
                b += lr * x.T @ (solved[:, size:] - solved[:, :size] @ b)
            made.append((a.ravel(), b.ravel()))
        heads = pd.concat([g[[*keys, "_node"]].iloc[:1] for g in groups], ignore_index=True)
        return told(heads, _a=[m[0] for m in made], _b=[m[1] for m in made])

    def compose(groups: list[pd.DataFrame]) -> pd.DataFrame:
        made = []
        for pdf in groups:
            a, b = np.eye(size), np.zeros((size, outputs))
            for ra, rb in zip(pdf["_a"], pdf["_b"]):
                m = np.asarray(ra).reshape(size, size)
                a, b = m @ a, m @ b + np.asarray(rb).reshape(size, outputs)
            made.append((a.ravel(), b.ravel()))
        heads = pd.concat([g[[*keys, "_parent"]].iloc[:1] for g in groups], ignore_index=True)
        heads = heads.rename(columns={"_parent": "_node"})
        return told(heads, _a=[m[0] for m in made], _b=[m[1] for m in made])

    def starts(groups: list[pd.DataFrame]) -> pd.DataFrame:
        """Weights at the start of every node, carried over by order from those of
        its parent, so that missing positions and whole missing nodes do not matter."""
        heads, found = [], []
        for pdf in groups:
            w = np.full((size, outputs), init)
            if pdf["_w"].iloc[0] is not None:  # the parent's weights sort first
                w = np.asarray(pdf["_w"].iloc[0]).reshape(size, outputs)
                pdf = pdf.iloc[1:]
            heads.append(pdf[[*keys, "_node"]])
            for ra, rb in zip(pdf["_a"], pdf["_b"]):
                found.append(w.ravel())
                w = np.asarray(ra).reshape(size, size) @ w + np.asarray(rb).reshape(size, outputs)
        return told(pd.concat(heads, ignore_index=True), _w=found)

    def replay(groups: list[pd.DataFrame]) -> pd.DataFrame:
        done = []
        for pdf in groups:
            w = np.full((size, outputs), init)
            if pdf["_w"].iloc[0] is not None:  # the start weights sort first
                w = np.asarray(pdf["_w"].iloc[0]).reshape(size, outputs)
                pdf = pdf.iloc[1:]
            if pdf.empty:
                continue
            pred, _ = replayed(w, *_arrays(pdf), lr)
            done.append(pdf[[*passed, "_y"]].assign(pred=list(pred)))
        if not done:
            empty = groups[0].iloc[:0][[*passed, "_y"]].rename(columns={"_y": "actual"})
            return empty.assign(pred=pd.Series(dtype=object))
        return pd.concat(done, ignore_index=True).rename(columns={"_y": "actual"})

    long_rows, top = _of_many_blocks(rows, keys)
    joined = rows.withColumn("_w", F.lit(None).cast("array<double>"))
    if top:
        few = dict(max_rows=min(fan, 1 << 16))  # bundles stay below two nodes of maps
        maps = map_sorted_groups(long_rows, [*keys, "_node"], [rank], as_maps, f"{key_ddl}_node bigint, {map_ddl}")
        levels = [materialise(maps, "linear-maps")]
        while top >= fan:
            top //= fan
            up = levels[-1].withColumn("_parent", F.expr(f"_node div {int(fan)}"))
            up = map_sorted_groups(up, [*keys, "_parent"], ["_node"], compose, f"{key_ddl}_node bigint, {map_ddl}", **few)
            levels.append(materialise(up, "linear-maps"))
        entering = None
        for maps in reversed(levels):
            down = maps.withColumns({"_parent": F.expr(f"_node div {int(fan)}"), "_w": F.lit(None).cast("array<double>")})
            if entering is not None:
                above = entering.withColumnRenamed("_node", "_parent")
                down = down.unionByName(above, allowMissingColumns=True)
            entering = map_sorted_groups(
                down, [*keys, "_parent"], [F.col("_w").isNull(), "_node"], starts, f"{key_ddl}_node bigint, _w array<double>", **few
            )
        # the weights behind a block enter the next one as a carry row
        joined = joined.unionByName(entering, allowMissingColumns=True)
    out_ddl = ", ".join(f"{c} {fields[c]}" for c in passed)
    return map_sorted_groups(
        joined,
        [*keys, "_node"],
        [F.col("_w").isNull(), rank],
        replay,
        f"{out_ddl}, actual array<double>, pred array<double>",
    )


def _of_many_blocks(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows of the keys that have more than one block, and the last block of all
    of those (0 if there is none). Reads the keys and positions only."""
    ends = rows.groupBy(*keys).agg(F.min("_node").alias("_first"), F.max("_node").alias("_last"))
    ends = ends.where("_first < _last")
    if keys:
        # at most one key for every block of rows
        ends = materialise(ends, "long-keys")
    top = ends.agg(F.max("_last")).first()[0] or 0
    if keys and top:
        named = ends.select(*[F.col(k).alias(f"_long_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_long_{k}")) for k in keys])
        rows = rows.join(named, same, "left_semi")
    return rows, top

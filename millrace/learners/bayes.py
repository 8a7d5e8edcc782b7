"""Gaussian naive Bayes scored before it learns, as one DataFrame plan.

A row of block ``b`` is scored with the model of all rows in blocks ``< b``.
Sums, squares and counts are additive, so the models of all blocks come from one
partial aggregate and a scan over the (small) block table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.carried import matrix_of, score_carried
from millrace.operators.order import fixed_block, full_count_windows
from millrace.operators.scan import State, running
from millrace.runtime import materialise

VARIANCE_FLOOR = 1e-6


def block_cells(
    df: DataFrame, block: str, features: str, label: str, keys: Sequence[str] = ()
) -> DataFrame:
    """``n``, sum and sum of squares per block, label and feature. Exploding the
    vector keeps the aggregate inside generated code (one wide aggregate per
    element does not), and the map-side combine shrinks it before the shuffle."""
    labelled = df.filter(F.col(label).isNotNull())
    cells = labelled.select(*keys, block, label, F.posexplode(features).alias("i", "_x"))
    x = F.col("_x").cast("double")
    return cells.groupBy(*keys, block, label, "i").agg(
        F.count("*").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("ss")
    )


def _every_class(df: DataFrame, block: str, label: str, classes: Sequence[int], width: int, keys):
    """Empty cells for every (block, class, feature), so that a class absent from
    a block still carries its totals forward. ``classes`` is the fixed class list
    of the task and ``width`` the fixed vector length."""
    blocks = df.select(*keys, block).distinct()
    return (
        blocks.withColumn(label, F.explode(F.array(*[F.lit(int(c)) for c in classes])))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
        .withColumns({"n": F.lit(0).cast("bigint"), "s": F.lit(0.0), "ss": F.lit(0.0)})
    )


def snapshots(
    df: DataFrame,
    block: str,
    features: str,
    label: str,
    width: int,
    classes: Sequence[int],
    keys: Sequence[str] = (),
    after: bool = False,
) -> DataFrame:
    """The model that scores each block: ``params`` is an array with one struct
    ``(label, n, mean, var)`` per class seen in earlier blocks. ``after`` gives
    the model at the end of the block instead."""
    keys = list(keys)
    cells = (
        block_cells(df, block, features, label, keys)
        .unionByName(_every_class(df, block, label, classes, width, keys))
        .groupBy(*keys, block, label, "i")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    )
    before = running(
        cells,
        block,
        {"pn": State(F.col("n")), "ps": State(F.col("s")), "pss": State(F.col("ss"))},
        [*keys, label, "i"],
        inclusive=after,
        widths=(1 << 12,),
        hot_rows=None,
    )
    sums = [F.col("pn").alias("n"), F.col("ps").alias("s"), F.col("pss").alias("ss")]
    return models_of(before.select(*keys, block, label, "i", *sums), label, [*keys, block])


def models_of(sums: DataFrame, label: str, by: Sequence[str] = ("block",)) -> DataFrame:
    """``params`` of every group ``by`` from its cells (``n``, ``s``, ``ss``)."""
    mean = F.col("s") / F.col("n")
    var = F.greatest(F.lit(VARIANCE_FLOOR), F.col("ss") / F.col("n") - mean * mean)
    cell = F.struct("i", mean.alias("m"), var.alias("v"))
    per_class = (
        sums.filter("n > 0")
        .groupBy(*by, label)
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(cell)).alias("mv"))
    )
    params = F.struct(
        F.col(label).alias("label"),
        "n",
        F.transform("mv", lambda e: e["m"]).alias("mean"),
        F.transform("mv", lambda e: e["v"]).alias("var"),
    )
    return per_class.groupBy(*by).agg(F.sort_array(F.collect_list(params)).alias("params"))


def snapshot_stream(
    df: DataFrame,
    rank: str,
    features: str,
    label: str,
    width: int,
    classes: Sequence[int],
    every: int,
) -> DataFrame:
    """Snapshots as a stream of their own: one after every ``every`` rows, with
    its version number and the first position it may score."""
    blocked = df.withColumn("_b", fixed_block(rank, every))
    models = snapshots(blocked, "_b", features, label, width, classes, after=True)
    full = full_count_windows(df, rank, every).select(F.col("block").alias("_b"))
    return models.join(full, "_b").select(
        (F.col("_b") + 1).alias("version"),
        ((F.col("_b") + 1) * every).alias("valid_from"),
        "params",
    )


TWO_PI = 6.283185307179586


def packed(models: DataFrame) -> DataFrame:
    """Per class the constant part of the log score and half the inverse
    variances, worked out once per model instead of once per row."""

    def pack(p):
        logs = F.aggregate(
            p["var"], F.lit(0.0), lambda acc, v: acc + F.log(v * F.lit(TWO_PI))
        )
        return F.struct(
            p["label"].alias("label"),
            (F.log(p["n"].cast("double")) - logs / 2).alias("base"),
            p["mean"].alias("mean"),
            F.transform(p["var"], lambda v: F.lit(0.5) / v).alias("inv"),
        )

    return models.withColumn("params", F.transform("params", pack))


def predicted(params: Column, features: Column, width: int, default: int = 0) -> Column:
    """Label with the highest log prior plus Gaussian log likelihood, the lowest
    label on a tie, and ``default`` where no model exists yet."""

    def of_class(p):
        def add(acc, i):
            d = F.get(features, i) - F.get(p["mean"], i)
            return acc + d * d * F.get(p["inv"], i)

        spread = F.aggregate(F.sequence(F.lit(0), F.lit(width - 1)), F.lit(0.0), add)
        return F.struct((p["base"] - spread).alias("s"), (-p["label"]).alias("l"))

    return F.coalesce(-F.array_max(F.transform(params, of_class))["l"], F.lit(default)).cast("int")


def _gaussian_labels(model: pa.Scalar, x: np.ndarray) -> np.ndarray:
    """``predicted`` for a matrix of rows."""
    classes = model.values
    labels = classes.field("label").to_numpy(zero_copy_only=False)
    base = classes.field("base").to_numpy(zero_copy_only=False)
    mean = matrix_of(classes.field("mean"), x.shape[1])
    inv = matrix_of(classes.field("inv"), x.shape[1])
    # |x - m|^2 / v, class by class: no array of rows x classes x features
    scores = np.empty((len(x), len(labels)))
    for c in range(len(labels)):
        d = x - mean[c]
        scores[:, c] = base[c] - np.einsum("nd,nd,d->n", d, d, inv[c])
    scores[np.isnan(scores)] = -np.inf
    # labels ascend, so the first maximum is the lowest label
    return labels[np.argmax(scores, axis=1)]


def score_blocks(
    df: DataFrame,
    models: DataFrame,
    block: str,
    features: str,
    width: int,
    keys: Sequence[str] = (),
    name: str = "pred",
    gate: bool = False,
    default: int = 0,
) -> DataFrame:
    """Score rows with the model of their block, whatever the number of models:
    each enters its block as a carry row. Rows before the first model get
    ``default``, or are left out with ``gate``."""
    vec = df.columns.index(features)

    def work(model: pa.Scalar, rows: pa.RecordBatch) -> pa.Array:
        return pa.array(_gaussian_labels(model, matrix_of(rows.column(vec), width)))

    return score_carried(
        df, packed(models), [*keys, block], "params", work, name, T.IntegerType(), default, gate
    )


def prequential_naive_bayes(
    df: DataFrame,
    block: str,
    features: str,
    label: str,
    width: int,
    classes: Sequence[int],
    keys: Sequence[str] = (),
    name: str = "pred",
) -> DataFrame:
    """Every row scored by the model of the blocks before its own. The snapshot
    table is written to the shared folder once."""
    models = materialise(
        snapshots(df, block, features, label, width, classes, keys), "bayes-models"
    )
    return score_blocks(df, models, block, features, width, keys, name)

"""Running and windowed evaluation metrics.

Progress reports (one line every N rows) never compute a per-row running value:
rows are reduced to one total per N-row block by a partial aggregate and only
the block table is scanned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.order import fixed_block, full_count_windows
from millrace.operators.scan import State, count_state, decayed, running


def prequential_accuracy(
    df: DataFrame, order: str, correct: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows seen, rows right, and their ratio, up to and including each row."""
    out = running(
        df,
        order,
        {"seen": count_state(), "hits": State(correct.cast("bigint"))},
        keys,
    )
    return out.withColumn("accuracy", F.col("hits") / F.col("seen"))


def warmup_accuracy(
    df: DataFrame,
    order: str,
    correct: Column,
    warmup: int,
    keys: Sequence[str] = (),
    seen: str | None = None,
) -> DataFrame:
    """Accuracy that starts to count at the ``warmup``-th row of a key; earlier
    rows only train and are not in the result. ``seen`` names a column that
    already holds the 1-based position per key, which saves one scan."""
    if seen is None:
        df = running(df, order, {"seen": count_state()}, keys)
    else:
        df = df.withColumnRenamed(seen, "seen")
    tested = df.filter(F.col("seen") >= warmup)
    out = running(tested, order, {"hits": State(correct.cast("bigint"))}, keys)
    return out.withColumn("accuracy", F.col("hits") / (F.col("seen") - F.lit(warmup - 1)))


def progress(
    df: DataFrame, rank: str, every: int, totals: Mapping[str, Column]
) -> DataFrame:
    """Running totals at every ``every``-th row: ``seen`` plus one running sum
    per entry of ``totals``. The last, partial stretch gives no line."""
    blocks = df.groupBy(fixed_block(rank, every).alias("block")).agg(
        F.count("*").alias("_rows"), *[F.sum(c).alias(n) for n, c in totals.items()]
    )
    lines = running(
        blocks, "block", {"seen": State(F.col("_rows")), **{n: State(F.col(n)) for n in totals}}
    )
    return lines.filter(F.col("_rows") == every).drop("_rows")


def accuracy_progress(df: DataFrame, rank: str, correct: Column, every: int) -> DataFrame:
    out = progress(df, rank, every, {"hits": correct.cast("bigint")})
    return out.withColumn("accuracy", F.col("hits") / F.col("seen"))


def error_progress(
    df: DataFrame, rank: str, actual: str, pred: str, outputs: int, every: int, scale: float = 1.0
) -> DataFrame:
    """Running mean absolute error of each output at every ``every``-th row."""
    errors = {f"e{i}": F.abs(F.col(actual)[i] - F.col(pred)[i]) for i in range(outputs)}
    out = progress(df, rank, every, errors)
    maes = F.array(*[F.col(f"e{i}") / F.col("seen") * F.lit(scale) for i in range(outputs)])
    return out.select("block", "seen", F.posexplode(maes).alias("output", "mae"))


def running_mae(df: DataFrame, order: str, actual: str, pred: str, outputs: int) -> DataFrame:
    """Mean absolute error of each output up to each row; one scan for all of
    them, expanded to one row per output afterwards."""
    states = {"seen": count_state()}
    for i in range(outputs):
        states[f"_e{i}"] = State(F.abs(F.col(actual)[i] - F.col(pred)[i]))
    out = running(df, order, states)
    maes = F.array(*[F.col(f"_e{i}") / F.col("seen") for i in range(outputs)])
    kept = [c for c in out.columns if not c.startswith("_e")]
    return out.select(*kept, F.posexplode(maes).alias("output", "mae"))


def total_mae_progress(
    df: DataFrame, rank: str, actual: str, pred: str, every: int
) -> DataFrame:
    """Absolute errors summed over the outputs, divided by rows (not by
    outputs), every ``every`` rows."""
    per_row = F.aggregate(
        F.zip_with(actual, pred, lambda a, p: F.abs(a - p)), F.lit(0.0), lambda acc, e: acc + e
    )
    out = progress(df, rank, every, {"abs_error": per_row})
    return out.select("block", "seen", (F.col("abs_error") / F.col("seen")).alias("mae"))


def ewma_accuracy(
    df: DataFrame,
    rank: str,
    correct: Column,
    alpha: float,
    bias: str = "power",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Exponentially weighted accuracy ``a = alpha*a + (1-alpha)*correct`` and
    its bias-corrected form. ``rank`` is a gapless 0-based position per key.

    ``bias='power'`` divides by ``1 - alpha^n``; ``'squaring'`` by
    ``1 - alpha^(2^(n-1))``, as if the running power were squared on each row.

    The average is an affine scan (``scan.decayed``) with bounded blocks for any
    ``alpha``. An unknown answer counts as a wrong one.
    """
    if not 0.0 < alpha < 1.0:
        raise ValueError("alpha must lie between 0 and 1")
    if bias not in ("power", "squaring"):
        raise ValueError("bias must be 'power' or 'squaring'")
    rows = decayed(df, rank, correct.cast("double"), alpha, "raw", keys)
    rows = rows.withColumn("raw", F.col("raw") * (1 - alpha))
    n = F.col(rank) + 1
    if bias == "power":
        left = F.pow(F.lit(alpha), n)
    else:
        # beyond 2^60 every power of alpha below one is zero in a double
        left = F.pow(F.lit(alpha), F.pow(F.lit(2.0), F.least(n - 1, F.lit(60))))
    return rows.withColumn("corrected", F.col("raw") / (1 - left))


def window_accuracy(df: DataFrame, rank: str, correct: Column, size: int) -> DataFrame:
    """Share of right answers in each full count window."""
    return full_count_windows(
        df, rank, size, F.avg(correct.cast("double")).alias("accuracy")
    )


def confusion_matrix(df: DataFrame, actual: Column, pred: Column, levels: int) -> DataFrame:
    """Counts on the full ``levels x levels`` grid, zeros included. Pairs with a
    missing side are left out here; see ``unpaired_count``."""
    counts = (
        df.select(actual.cast("int").alias("actual"), pred.cast("int").alias("pred"))
        .filter("actual is not null and pred is not null")
        .groupBy("actual", "pred")
        .agg(F.count("*").alias("n"))
    )
    axis = F.sequence(F.lit(0), F.lit(levels - 1))
    grid = (
        df.sparkSession.range(1)
        .select(F.explode(axis).alias("actual"))
        .select("actual", F.explode(axis).alias("pred"))
    )
    return grid.join(counts, ["actual", "pred"], "left").select(
        "actual", "pred", F.coalesce("n", F.lit(0)).alias("n")
    )


def unpaired_count(df: DataFrame, actual: Column, pred: Column) -> DataFrame:
    return df.agg(
        F.coalesce(F.sum((actual.isNull() | pred.isNull()).cast("bigint")), F.lit(0)).alias("n")
    )


def running_confusion(
    df: DataFrame, order: str, actual: Column, pred: Column, levels: int
) -> DataFrame:
    """Every cell of the confusion matrix as a running count; column
    ``c<actual><pred>``."""
    cells = {
        f"c{a}{p}": State(((actual == a) & (pred == p)).cast("bigint"))
        for a in range(levels)
        for p in range(levels)
    }
    return running(df, order, cells)


def vector_average(df: DataFrame, vector: str, by: Sequence[str | Column]) -> DataFrame:
    """Element-wise mean of an array column per group, kept as partial sums and
    counts per element until the last step."""
    groups = [c if isinstance(c, Column) else F.col(c) for c in by]
    parts = df.select(*groups, F.posexplode(vector).alias("_i", "_x"))
    names = [c for c in parts.columns if c not in ("_i", "_x")]
    means = parts.groupBy(*names, "_i").agg(F.avg("_x").alias("_m"), F.count("*").alias("_n"))
    return means.groupBy(*names).agg(
        F.max("_n").alias("n"),
        F.transform(F.sort_array(F.collect_list(F.struct("_i", "_m"))), lambda e: e["_m"]).alias(
            "mean"
        ),
    )

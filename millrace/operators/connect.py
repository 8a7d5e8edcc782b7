"""Joining a data stream with a stream of model snapshots, and gathering the
predictions of several models back into one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.features import binary_vote
from millrace.operators.order import fixed_block
from millrace.operators.scan import WIDTHS, State, running


def with_latest(
    df: DataFrame,
    order: str,
    snapshots: Mapping[str, DataFrame],
    valid_from: str = "valid_from",
    params: str = "params",
    gate: bool = False,
    widths: Sequence[int] = WIDTHS,
    by_reference: bool = False,
) -> DataFrame:
    """Add, per entry of ``snapshots``, the newest ``params`` whose ``valid_from``
    is at or before the row. Snapshots may come at any position.

    Rows and snapshots are put in one order and the latest non-null snapshot of
    each model is carried along it, so any number of models costs one shuffle
    and each snapshot is copied once per block, not once per row.
    ``gate`` keeps only rows that every model can score. ``by_reference`` is for
    models that are large beside a row: the scan carries ``valid_from`` alone, and
    the model is joined to it, by broadcast or shuffle as its stored size asks for.
    ``valid_from`` must then be unique within a model's snapshots.
    """
    names = list(snapshots)
    if by_reference:
        marks = {n: s.select(valid_from, F.col(valid_from).alias(params)) for n, s in snapshots.items()}
        out = with_latest(df, order, marks, valid_from, params, gate, widths)
        for n, snap in snapshots.items():
            models = snap.select(F.col(valid_from).alias("_from"), F.col(params).alias("_params"))
            out = out.join(models, F.col(n) == F.col("_from"), "left").drop(n, "_from").withColumnRenamed("_params", n)
        return out
    step = len(names) + 1
    # a snapshot sorts before the row that shares its position
    merged = df.withColumns(
        {"_at": F.col(order) * step + len(names), "_row": F.lit(True)}
    )
    for i, name in enumerate(names):
        snap = snapshots[name].select(
            (F.col(valid_from) * step + i).alias("_at"),
            F.lit(False).alias("_row"),
            F.col(params).alias(name),
        )
        merged = merged.unionByName(snap, allowMissingColumns=True)
    out = running(
        merged,
        "_at",
        {n: State(F.col(n), "last") for n in names},
        widths=(widths[0] * step, *widths[1:]),
    ).filter("_row")
    if gate:
        for n in names:
            out = out.filter(F.col(n).isNotNull())
    return out.drop("_at", "_row")


def with_latest_regular(
    df: DataFrame, rank: str, snapshots: DataFrame, every: int, name: str, gate: bool = False
) -> DataFrame:
    """The same for snapshots that come after every ``every`` rows: an equi-join
    on the block number. The planner broadcasts by measured size or shuffles."""
    keyed = snapshots.select(
        F.expr(f"valid_from div {int(every)}").alias("_block"), F.col("params").alias(name)
    )
    joined = df.withColumn("_block", fixed_block(rank, every)).join(
        keyed, "_block", "inner" if gate else "left"
    )
    return joined.drop("_block")


def majority_vote(counts: Column) -> Column:
    """Class with the most rows in a count vector, the first on a tie, and class
    0 where there is no model."""
    pick = F.array_position(counts, F.array_max(counts)) - 1
    return F.coalesce(pick, F.lit(0)).cast("int")


def append_flags(
    df: DataFrame,
    votes: Sequence[Column],
    label: str | None = None,
    kind: str = "vote",
    name: str = "flags",
) -> DataFrame:
    """One boolean per model. ``kind='vote'``: the model votes for class 0.
    ``kind='correct'``: its class equals the label, which leaks the label into
    whatever learns from the flags; kept for comparison only."""
    if kind == "vote":
        flags = [binary_vote(v) for v in votes]
    elif kind == "correct":
        flags = [majority_vote(v) == F.col(label) for v in votes]
    else:
        raise ValueError("kind must be 'vote' or 'correct'")
    return df.withColumn(name, F.array(*flags))


def gather(
    tagged: DataFrame,
    models: int,
    by: Sequence[str] = ("seq",),
    model: str = "model_idx",
    pred: str = "pred",
    actual: str = "actual",
) -> DataFrame:
    """The predictions of one record, one slot per model. A missing slot holds
    0.0 and ``complete`` is false. Conditional aggregates combine map-side."""
    found = [F.max(F.when(F.col(model) == i, F.col(pred).cast("double"))) for i in range(models)]
    complete = F.lit(True)
    for slot in found:  # a repeated prediction does not stand in for a missing one
        complete = complete & slot.isNotNull()
    return tagged.groupBy(*by).agg(
        F.array(*[F.coalesce(slot, F.lit(0.0)) for slot in found]).alias("features"),
        F.max(actual).alias("actual"),
        complete.alias("complete"),
    )


def incomplete(gathered: DataFrame) -> DataFrame:
    return gathered.filter(~F.col("complete"))


def tag_predictions(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Union of the models' outputs, each row marked with its model number."""
    out = None
    for i, frame in enumerate(frames):
        part = frame.select(*columns, F.lit(i).alias("model_idx"))
        out = part if out is None else out.unionByName(part)
    return out

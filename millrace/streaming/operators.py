"""Streaming forms of the operators. Windows and gathering use the state store;
running state, global or per key, is carried through each micro-batch from the
state that the batch before it wrote."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.learners import bayes, linear
from millrace.operators.carried import learn_carried, matrix_of
from millrace.operators.connect import with_latest
from millrace.operators.scan import State, running
from millrace.streaming.run import BatchState, write_batch

# --- event time -----------------------------------------------------------------


def windowed(
    stream: DataFrame,
    ts: str,
    size: str,
    aggs: Sequence[Column],
    slide: str | None = None,
    delay: str = "0 seconds",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Event-time windows behind a watermark: ``delay='0 seconds'`` for ordered
    timestamps, otherwise the allowed disorder. Later rows are dropped by the
    watermark; audit them in batch with ``late_rows``."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    window = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    return timed.withWatermark("_ts", delay).groupBy(window.alias("window"), *keys).agg(*aggs)


def flatten_stream(
    stream: DataFrame,
    ts: str,
    seq: str,
    features: str,
    targets: str,
    size: str,
    slide: str,
    rows: int,
    delay: str = "0 seconds",
) -> DataFrame:
    """Sliding windows as flat vectors, and ``n`` for the short ones (``features``
    is NULL there, as it is where one of the vectors is missing). The state of an open
    window is a count and its first ``rows`` rows in (time, arrival) order, however
    crowded it is; a window comes out when the watermark has passed its end."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    members = timed.select(
        F.window("_ts", size, slide).alias("window"),  # late rows are dropped by its end
        F.unix_micros("_ts").alias("_at"),
        F.coalesce(F.col(seq).cast("bigint"), F.lit(-(2**63))).alias("_seq"),
        F.col(features).cast("array<double>").alias("_f"),
        F.col(targets).cast("array<double>").alias("_t"),
    ).withColumns(
        {"_from": F.unix_micros("window.start"), "_to": F.unix_micros("window.end")}
    )
    names = ["_at", "_seq", "_f", "_t"]

    def first_rows(
        window: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        start, end = (int(v) for v in window)
        n, *held = state.get if state.exists else (0, [], [], [], [])
        if state.hasTimedOut:
            state.remove()
            whole = n >= rows and all(v is not None for v in held[2])
            flat = [v for vector in held[2] for v in vector] if whole else None
            yield pd.DataFrame(
                {
                    "_from": [start],
                    "_to": [end],
                    "n": [n],
                    "features": [flat],
                    "targets": [held[3][-1] if n >= rows else None],
                }
            )
            return
        kept = pd.DataFrame(dict(zip(names, held)), dtype=object)
        for pdf in batches:
            n += len(pdf)
            both = pd.concat([kept, pdf[names].astype(object)], ignore_index=True)
            kept = both.sort_values(["_at", "_seq"], kind="stable").head(rows)
        numbers = [[int(v) for v in kept[c]] for c in ("_at", "_seq")]
        vectors = [[None if v is None else [*map(float, v)] for v in kept[c]] for c in ("_f", "_t")]
        state.update((n, *numbers, *vectors))
        # open windows end after the watermark; the time must lie after it too
        state.setTimeoutTimestamp(max(end // 1000 - 1, state.getCurrentWatermarkMs() + 1))

    closed = members.groupBy("_from", "_to").applyInPandasWithState(
        first_rows,
        "_from bigint, _to bigint, n bigint, features array<double>, targets array<double>",
        "n bigint, at array<bigint>, seq array<bigint>, f array<array<double>>, t array<array<double>>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    window = F.struct(
        F.timestamp_micros("_from").alias("start"), F.timestamp_micros("_to").alias("end")
    )
    return closed.select(window.alias("window"), "n", "features", "targets")


def confusion_stream(stream: DataFrame, actual: Column, pred: Column) -> DataFrame:
    """Counts per (actual, predicted) pair over the whole stream, for the complete
    or update output mode. ``metrics.confusion_matrix`` fills the empty cells."""
    pairs = stream.select(actual.alias("actual"), pred.alias("pred"))
    return (
        pairs.filter("actual is not null and pred is not null")
        .groupBy("actual", "pred")
        .agg(F.count("*").alias("n"))
    )


def gather_stream(
    tagged: DataFrame, ts: str, models: int, size: str = "1 second", delay: str = "30000 seconds",
    by: Sequence[str] = (),
) -> DataFrame:
    """Predictions of one record, brought together by their event-time window."""
    found = [F.max(F.when(F.col("model_idx") == i, F.col("pred"))) for i in range(models)]
    complete = F.lit(True)
    for slot in found:
        complete = complete & slot.isNotNull()
    aggs = [
        F.array(*[F.coalesce(slot, F.lit(0.0)) for slot in found]).alias("features"),
        F.max("actual").alias("actual"),
        complete.alias("complete"),
    ]
    return windowed(tagged, ts, size, aggs, delay=delay, keys=by)


# --- global running state, batch by batch ------------------------------------------


def running_sums(
    spark: SparkSession,
    out: str,
    state_path: str,
    order: str,
    values: dict[str, Column],
    inclusive: bool = True,
    kind: str = "double",
) -> Callable[[DataFrame, int], None]:
    """Handler that adds running sums over the whole stream so far. The state is
    one row: the totals, of type ``kind`` (``bigint`` keeps counts exact)."""
    names = list(values)
    state = BatchState(spark, state_path, ", ".join(f"{n} {kind}" for n in names))
    zero = F.lit(0).cast(kind)

    def handle(batch: DataFrame, batch_id: int) -> None:
        start = state.before(batch_id).first()
        base = [zero if start is None else F.lit(start[n]).cast(kind) for n in names]
        batch = batch.persist()  # read by the scan's two passes and by the totals
        scanned = running(
            batch, order, {n: State(values[n].cast(kind)) for n in names}, inclusive=inclusive
        )
        write_batch(
            scanned.withColumns({n: F.col(n) + b for n, b in zip(names, base)}), out, batch_id
        )
        totals = batch.agg(
            *[
                (F.coalesce(F.sum(values[n].cast(kind)), zero) + b).alias(n)
                for n, b in zip(names, base)
            ]
        )
        state.save(totals, batch_id)
        batch.unpersist()

    return handle


def majority_stream(
    spark: SparkSession, out: str, state_path: str, order: str, label: str, classes: Sequence[int]
) -> Callable[[DataFrame, int], None]:
    """Majority class over the whole stream so far, scored before learning."""
    counts = {f"c{c}": (F.col(label) == c).cast("bigint") for c in classes}
    scan = running_sums(spark, f"{out}-counts", state_path, order, counts, inclusive=False, kind="bigint")

    def handle(batch: DataFrame, batch_id: int) -> None:
        scan(batch, batch_id)
        rows = spark.read.parquet(f"{out}-counts/batch={batch_id}")
        best = F.greatest(*counts)
        pick = F.coalesce(*[F.when(F.col(f"c{c}") == best, F.lit(int(c))) for c in classes])
        write_batch(rows.withColumn("pred", pick).drop(*counts), out, batch_id)

    return handle


def bayes_stream(
    spark: SparkSession,
    out: str,
    state_path: str,
    features: str,
    label: str,
    width: int,
    classes: Sequence[int],
) -> Callable[[DataFrame, int], None]:
    """Naive Bayes with one model per micro-batch: a batch is scored with the
    sums of the batches before it, then added to them."""
    cells = BatchState(
        spark, state_path, f"block int, {label} int, i int, n bigint, s double, ss double"
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        sums = cells.before(batch_id)
        rows = batch.withColumn("block", F.lit(0)).persist()  # read by scores and sums
        scored = bayes.score_blocks(rows, bayes.models_of(sums, label), "block", features, width)
        write_batch(scored.drop("block"), out, batch_id)
        fresh = bayes.block_cells(rows, "block", features, label)
        total = (
            sums.unionByName(fresh)
            .groupBy("block", label, "i")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
        )
        cells.save(total, batch_id)
        rows.unpersist()

    return handle


def latest_model_stream(
    out: str,
    order: str,
    snapshots: Callable[[], DataFrame],
    score: Callable[[DataFrame], DataFrame],
    valid_from: str = "valid_from",
) -> Callable[[DataFrame, int], None]:
    """Score a stream with whatever model snapshots have been published when the
    micro-batch starts; ``snapshots()`` reads the snapshot folder anew. Of the
    folder a batch reads the positions, then only the newest model before its first
    row and those inside its range (a filter on ``valid_from`` that reaches the scan)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        first, last = batch.agg(F.min(order), F.max(order)).first()
        known = snapshots()
        if first is not None:
            newest = known.filter(F.col(valid_from) <= first).agg(F.max(valid_from)).first()[0]
            since = first if newest is None else newest
            known = known.filter(F.col(valid_from).between(since, last))
        write_batch(score(with_latest(batch, order, {"model": known}, valid_from)), out, batch_id)
        batch.unpersist()

    return handle


# --- keyed learners, batch by batch ----------------------------------------------------


def keyed_stream(
    spark: SparkSession,
    out: str,
    state_path: str,
    key: str,
    key_type: str,
    order: str,
    columns: dict[str, Column],
    start: Sequence[float],
    step: Callable,
    made: str,
    finish: Callable[[DataFrame], DataFrame],
) -> Callable[[DataFrame, int], None]:
    """Handler for a learner per key, exact for every row. The state of a key is a
    vector of numbers and enters a micro-batch before the rows of its key, which are
    sorted by ``order`` in the shuffle; a key with millions of rows in one batch is
    read in Arrow batches like any other. The table of states is written anew by
    every batch, so batches should be large beside the number of keys."""
    state = BatchState(spark, state_path, f"{key} {key_type}, state array<double>")
    fields = T.StructType.fromDDL(made)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(
            F.col(key).cast(key_type).alias(key),
            F.col(order).cast("bigint").alias(order),
            *[c.alias(n) for n, c in columns.items()],
        )
        learned = learn_carried(rows, state.before(batch_id), [key], order, start, step, fields).persist()
        write_batch(finish(learned.filter("state is null").drop("state")), out, batch_id)
        state.save(learned.filter("state is not null").select(key, "state"), batch_id)
        learned.unpersist()

    return handle


def keyed_majority_stream(
    spark: SparkSession,
    out: str,
    state_path: str,
    key: str,
    key_type: str,
    order: str,
    label: str,
    classes: int,
    warmup: int = 1,
) -> Callable[[DataFrame, int], None]:
    """Majority class per key with warm-up. The state of a key is its row count,
    hits and class counts."""

    def step(state: np.ndarray, rows: pa.RecordBatch) -> tuple[dict[str, pa.Array], np.ndarray]:
        labels = rows.column(2).to_numpy(zero_copy_only=False)
        one_hot = (labels[:, None] == np.arange(classes)).astype(float)
        upto = state[2:] + np.cumsum(one_hot, axis=0)
        pred = (upto - one_hot).argmax(axis=1)
        seen = state[0] + 1 + np.arange(len(labels))
        hits = state[1] + np.cumsum((pred == labels) & (seen >= warmup))
        shares = hits / np.maximum(seen - warmup + 1, 1)
        found = {
            "seen": pa.array(seen.astype(np.int64)),
            "pred": pa.array(pred.astype(np.int32)),
            "accuracy": pa.array(shares),
        }
        return found, np.concatenate([[seen[-1], hits[-1]], upto[-1]])

    return keyed_stream(
        spark, out, state_path, key, key_type, order,
        {"_label": F.col(label).cast("int")}, [0.0] * (2 + classes), step,
        "seen bigint, pred int, accuracy double",
        lambda rows: rows.filter(F.col("seen") >= warmup).drop("_label"),
    )


def keyed_linear_stream(
    spark: SparkSession,
    out: str,
    state_path: str,
    key: str,
    key_type: str,
    order: str,
    features: str,
    targets: str,
    width: int,
    outputs: int,
    lr: float,
    init: float = 0.1,
) -> Callable[[DataFrame, int], None]:
    """Delta-rule learner per key; the state of a key is its weight matrix, and
    stretches of rows are solved together (``linear.replayed``)."""

    def step(state: np.ndarray, rows: pa.RecordBatch) -> tuple[dict[str, pa.Array], np.ndarray]:
        x, y = matrix_of(rows.column(2), width), matrix_of(rows.column(3), outputs)
        x = np.hstack([x, np.ones((len(x), 1))])
        pred, weights = linear.replayed(state.reshape(width + 1, outputs), x, y, lr)
        return {"pred": pa.array(list(pred))}, weights.ravel()

    return keyed_stream(
        spark, out, state_path, key, key_type, order,
        {"_x": F.col(features).cast("array<double>"), "actual": F.col(targets).cast("array<double>")},
        [init] * ((width + 1) * outputs), step, "pred array<double>",
        lambda rows: rows.drop("_x"),
    )

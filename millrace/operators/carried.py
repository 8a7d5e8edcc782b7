"""Rows scored as matrices with a model that travels with them, and learners whose
state enters a micro-batch in the same way.

A model is one row of its group (a block, or a leaf in a round). It is neither
copied to every row nor shipped to every task: it enters the rows of its group as
one carry row that sorts before them, and the Arrow batches behind it are scored as
they come. A group of more than ``SLICE_ROWS`` rows is cut into slices, each with
a carry row of its own, so that a group that holds a third of all rows is many
tasks' work. A task holds one batch and one model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.runtime import materialise

SLICE_ROWS = 1 << 14


def matrix_of(vectors: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of ``width`` columns. Missing vectors, elements
    and tails are NaN, elements beyond ``width`` are left out."""
    out = np.full((len(vectors), width), np.nan)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if len(flat) == len(vectors) * width and (lengths == width).all():
        return flat.reshape(len(vectors), width)
    row = np.repeat(np.arange(len(vectors)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = at < width
    out[row[inside], at[inside]] = flat[inside]
    return out


def _large_groups(df: DataFrame, on: Sequence[str], slice_rows: int) -> DataFrame:
    """Groups of more than one slice: at most one for every ``slice_rows`` rows.
    They are written out, so joins with them are planned from their real size."""
    sizes = df.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > slice_rows)
    named = [F.col(c).alias(f"_large_{c}") for c in on]
    slices = F.ceil(F.col("_n") / slice_rows).alias("_slices")
    return materialise(sizes.select(*named, slices), "large-groups")


def _with_slices(df: DataFrame, large: DataFrame | None, on: Sequence[str]) -> DataFrame:
    if large is None:
        return df.withColumn("_slices", F.lit(1).cast("bigint"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_large_{c}")) for c in on])
    joined = df.join(large, same, "left").drop(*[f"_large_{c}" for c in on])
    return joined.withColumn("_slices", F.coalesce("_slices", F.lit(1).cast("bigint")))


def score_carried(
    df: DataFrame,
    models: DataFrame,
    on: Sequence[str],
    model: str,
    work: Callable[[pa.Scalar, pa.RecordBatch], pa.Array],
    name: str,
    kind: T.DataType,
    missing: int | None = None,
    gate: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the column ``name``: ``work(model, rows)`` for the rows of one group
    (columns ``on``) and its model, the column ``model`` of ``models``, one row a
    group. Rows of a group without a model get ``missing``, with ``gate`` they are
    left out. ``work`` looks at each row by itself. The input is evaluated twice."""
    on = list(on)
    large = _large_groups(df, on, slice_rows)
    large = None if large.isEmpty() else large
    # which slice a row is in does not change its score; rows differ in some column
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = _with_slices(df, large, on).withColumns(
        {
            "_slice": F.pmod(F.xxhash64(*plain), F.col("_slices")),
            "_carry": F.lit(1),
        }
    )
    carries = _with_slices(models.select(*on, F.col(model).alias("_model")), large, on).select(
        *on,
        "_model",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1)).alias("_slice"),
        F.lit(0).alias("_carry"),
    )
    both = rows.drop("_slices").unionByName(carries, allowMissingColumns=True)
    # an explicit number keeps the adaptive planner from merging partitions by
    # their bytes: the time here goes into work per row
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        both.withColumn("_group", F.xxhash64(*on, "_slice"))
        .repartition(parts, *on, "_slice")
        .sortWithinPartitions(*on, "_slice", "_carry")
        .select(*df.columns, "_model", "_carry", "_group")
    )
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    names = [f.name for f in schema.fields]
    wide = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, None
        for batch in batches:
            total = batch.num_rows
            if not total:
                continue
            carry = batch.column(wide + 1).to_numpy(zero_copy_only=False) == 0
            groups = batch.column(wide + 2).to_numpy(zero_copy_only=False)
            turns = np.flatnonzero(carry | np.concatenate([[True], groups[1:] != groups[:-1]]))
            own = batch.select(range(wide))
            for a, b in zip(turns, [*turns[1:], total]):
                if carry[a]:
                    group, held = groups[a], batch.column(wide)[int(a)]
                    a += 1
                elif groups[a] != group:
                    group, held = groups[a], None
                if a == b or (held is None and gate):
                    continue
                part = own.slice(int(a), int(b - a))
                if held is None:
                    made = pa.array([missing] * (b - a))
                else:
                    made = work(held, part)
                columns = [*part.columns, made.cast(out_type)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out_type = pa.int32() if isinstance(kind, T.IntegerType) else pa.float64()
    return placed.mapInArrow(run, schema)


def learn_carried(
    rows: DataFrame,
    states: DataFrame,
    keys: Sequence[str],
    order: str,
    start: Sequence[float],
    step: Callable[[np.ndarray, pa.RecordBatch], tuple[dict[str, pa.Array], np.ndarray]],
    made: T.StructType,
) -> DataFrame:
    """Rows of every key in ``order`` through a learner whose state is a vector.
    ``states`` has the state that each known key starts with (``keys``, ``state``);
    other keys begin with ``start``. ``step(state, rows)`` gets a stretch of rows of
    one key and returns the columns ``made`` and the next state, so a task holds one
    batch however many rows a key has.

    The result has the rows with their new columns, and one row with ``state`` set
    and nothing else beside its key for every key of either table."""
    keys, wide = list(keys), len(rows.columns)
    both = rows.withColumn("_carry", F.lit(1)).unionByName(
        states.select(*keys, F.col("state").alias("_state"), F.lit(0).alias("_carry")),
        allowMissingColumns=True,
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        both.withColumn("_group", F.xxhash64(*keys))
        .repartition(parts, *keys)
        .sortWithinPartitions(*keys, "_carry", order)
        .select(*rows.columns, "_state", "_carry", "_group")
    )
    state_field = T.StructField("state", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*rows.schema.fields, *made.fields, state_field])
    names = [f.name for f in schema.fields]
    key_at = [rows.columns.index(k) for k in keys]
    arrow = to_arrow_schema(schema)

    def closing(key: pa.RecordBatch, state: np.ndarray) -> pa.RecordBatch:
        columns = [pa.nulls(1, f.type) for f in arrow]
        for i in key_at:
            columns[i] = key.column(i).cast(arrow.field(i).type)
        columns[-1] = pa.array([state.tolist()], arrow.field(len(names) - 1).type)
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key, state = None, None, None
        for batch in batches:
            total = batch.num_rows
            if not total:
                continue
            carry = batch.column(wide + 1).to_numpy(zero_copy_only=False) == 0
            groups = batch.column(wide + 2).to_numpy(zero_copy_only=False)
            turns = np.flatnonzero(carry | np.concatenate([[True], groups[1:] != groups[:-1]]))
            own = batch.select(range(wide))
            for a, b in zip(turns, [*turns[1:], total]):
                a, b = int(a), int(b)
                if groups[a] != group or key is None:
                    if key is not None:
                        yield closing(key, state)
                    group, key, state = groups[a], own.slice(a, 1), np.array(start, dtype=float)
                if carry[a]:
                    state = np.array(batch.column(wide)[a].as_py(), dtype=float)
                    a += 1
                if a == b:
                    continue
                part = own.slice(a, b - a)
                found, state = step(state, part)
                columns = [*part.columns, *[found[f.name] for f in made.fields], pa.nulls(b - a)]
                columns = [c.cast(f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if key is not None:
            yield closing(key, state)

    return placed.mapInArrow(run, schema)

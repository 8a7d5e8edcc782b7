"""Helpers that several operators share: joins that survive a hot key, gapless
numbers in bounded tasks, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.runtime import materialise

#: A key is hot when it holds more than one row in HOT_SHARE, so at most
#: HOT_SHARE keys are hot whatever the size of the table.
HOT_SHARE = 500


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row per ``key`` and
    in ``count`` the rows of that key on the left. The at most ``HOT_SHARE``
    hot keys are joined by a broadcast of their rows, the rest by a shuffle."""
    limit = total // HOT_SHARE + 1000
    hot = right.where(F.col(count) > limit).drop(count)
    cold = right.where(F.col(count) <= limit).drop(count)
    with_hot = left.join(F.broadcast(hot), key)
    without = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return with_hot.unionByName(without)


#: Outer blocks of a group whose totals are summed up in one task.
SUPER = 4096


def numbered(rows: DataFrame, group: list[str], order: Column, tie: Column, per_block: int = 50_000) -> DataFrame:
    """Adds ``number``, gapless from 0 in each ``group``. ``order`` and ``tie``
    are 64-bit hashes: rows are cut into blocks by bits of ``order``, then of
    ``tie``; a block that is still larger than ``per_block`` (one value of
    ``order`` with very many rows) is cut by as many values of other bits of ``tie``
    as its counted size asks for. So no task is larger than a few blocks. Block
    totals are summed up in two levels and meet their rows by the partitioning
    that the numbering needs anyway, without a broadcast."""
    total = rows.count()
    cuts = max(1, total // per_block)
    rows = rows.withColumns(
        {
            "_outer": F.pmod(F.shiftrightunsigned(order, 20), F.lit(cuts)),
            "_inner": F.pmod(F.shiftrightunsigned(tie, 20), F.lit(min(cuts, 64))),
            "_order": order,
            "_tie": tie,
        }
    )
    block = [*group, "_outer", "_inner"]
    counted = rows.groupBy(*block).agg(F.count("*").alias("_n"))
    if cuts > 64:  # else 64 inner blocks of one value of ``order`` are small enough
        deep = materialise(counted.where(F.col("_n") > per_block).select(*block, F.expr(f"_n div {per_block} + 1").alias("_cuts")), "deep")
        if not deep.isEmpty():
            rows = rows.join(deep.hint("merge"), block, "left")
            rows = rows.withColumn("_deep", F.pmod(F.shiftrightunsigned(F.xxhash64("_tie"), 8), F.coalesce("_cuts", F.lit(1)))).drop("_cuts")
            block = [*block, "_deep"]
            counted = rows.groupBy(*block).agg(F.count("*").alias("_n"))
    sizes = counted.withColumn("_super", F.expr(f"_outer div {SUPER}"))
    level = [*group, "_super"]
    supers = sizes.groupBy(*level).agg(F.sum("_n").alias("_all"))
    earlier = Window.partitionBy(*group).orderBy("_super").rowsBetween(Window.unboundedPreceding, 0)
    supers = supers.select(*level, (F.sum("_all").over(earlier) - F.col("_all")).alias("_base"))
    before = Window.partitionBy(*level).orderBy(*block[len(group) :]).rowsBetween(Window.unboundedPreceding, 0)
    starts = sizes.withColumn("_upto", F.sum("_n").over(before)).join(supers.hint("merge"), level)
    starts = starts.select(*block, (F.col("_base") + F.col("_upto") - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("_order", "_tie"))
    return (
        rows.withColumn("_at", inside)
        .join(starts.hint("merge"), block)
        .withColumn("number", F.col("_start") + F.col("_at") - 1)
        .drop(*block[len(group) :], "_order", "_tie", "_start", "_at")
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) by alternating large and
    small stars. Returns node, root: one row per node that has a link, root
    the smallest node of its component (itself included as a row)."""
    now = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    mark = _fingerprint(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), name)
        was, mark = mark, _fingerprint(now)
        if was == mark:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def slices(texts, size: int = 1_000_000):
    """Runs of texts of about ``size`` characters, or one longer text."""
    run, held = [], 0
    for text in texts:
        run.append(text or "")
        held += len(run[-1])
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def map_exact(rows: DataFrame, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInPandas``, but longs stay whole numbers in columns with nulls, where
    pandas alone would make them doubles."""
    target = to_arrow_schema(T.StructType.fromDDL(schema))
    whole = {pa.int64(): pd.Int64Dtype()}.get

    def exact(batches):
        for frame in run(pa.Table.from_batches([b]).to_pandas(types_mapper=whole) for b in batches):
            yield pa.RecordBatch.from_pandas(frame, schema=target, preserve_index=False)

    return rows.mapInArrow(exact, schema)

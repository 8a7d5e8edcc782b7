"""Positions in the arrival order, update blocks and count windows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.scan import State, count_state, running
from millrace.runtime import materialise


def with_rank(
    df: DataFrame,
    order: str,
    keys: Sequence[str] = (),
    name: str = "rank",
    dense_from: int | None = None,
) -> DataFrame:
    """0-based position of each row in ``order``. A source whose counter has no
    gaps says so with ``dense_from`` (its first value) and pays no shuffle, but
    one pass over that column: a gap, a repeat or a null raises."""
    if dense_from is not None and not keys:
        check_dense(df, order, dense_from)
        # the bare column keeps range filters on the position pushable
        return df.withColumn(name, F.col(order) - dense_from if dense_from else F.col(order))
    return running(df, order, {name: count_state()}, keys, inclusive=False)


def check_dense(df: DataFrame, order: str, first: int) -> None:
    """Raises unless ``order`` holds every whole number from ``first`` on once:
    its values must hash to the same as that range."""
    mark = lambda c: F.bit_xor(F.xxhash64(F.col(c).cast("long"))).alias("x")
    found = df.agg(F.count("*").alias("n"), F.count(order).alias("some"), mark(order)).first()
    want = df.sparkSession.range(first, first + found["n"]).agg(mark("id")).first()
    if found["some"] != found["n"] or found["x"] != want["x"]:
        raise ValueError(f"{order} is not a gapless counter from {first}; leave dense_from out")


def number_by(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Gapless positions along any ordering, also a compound one without a whole
    number in it. Rows are range-partitioned on all of ``order``, so a value that
    many rows share is still split, and written once; the written partitions are
    counted and every row is numbered from its partition's start."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialise(ordered.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    # the id holds the partition above bit 33 and the row's place in it below
    stored = stored.withColumn("_part", F.shiftright("_id", 33))
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = running(sizes, "_part", {"_start": State(F.col("_n"))}, inclusive=False)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.join(starts.select("_part", "_start"), "_part")
        .withColumn(name, F.col("_start") + place)
        .drop("_id", "_part", "_start")
    )


def fixed_block(rank: str, size: int) -> Column:
    """Index of the count window of ``size`` rows that holds this position."""
    return F.expr(f"`{rank}` div {int(size)}")


@dataclass(frozen=True)
class Rounds:
    """Update rounds of a learner: the first ``first`` positions are round 0, and
    every later round ends ``growth`` times as far from the start as it began; with
    ``growth`` 1 all rounds are ``first`` long, as of a model published at a fixed
    interval. The model that scores a row has seen at least 1/growth of the rows
    before it, but for the last round's own."""

    first: int = 1024
    growth: float = 2.0

    def __post_init__(self):
        if self.first < 1 or self.growth < 1:
            raise ValueError("rounds need first >= 1 and growth >= 1")

    def ends(self, upto: int = 1 << 60) -> list[int]:
        """Ends of the rounds that begin at or before ``upto``, for growth above 1."""
        out = [self.first]
        while out[-1] <= upto:
            out.append(min(max(out[-1] + 1, math.ceil(out[-1] * self.growth)), 1 << 62))
        return out

    def block(self, rank: str) -> Column:
        """Round of a position."""
        if self.growth == 1:
            return F.expr(f"cast(`{rank}` div {self.first} as int)")
        ends = self.ends()

        def among(lo: int, hi: int) -> str:  # comparisons as a balanced tree
            if lo == hi:
                return str(lo)
            mid = (lo + hi) // 2
            return f"if(`{rank}` < {ends[mid]}L, {among(lo, mid)}, {among(mid + 1, hi)})"

        return F.expr(among(0, len(ends) - 1))

    def bounds(self, block: int) -> tuple[int, int]:
        """First position of a round and the one behind its end."""
        if self.growth == 1:
            return block * self.first, (block + 1) * self.first
        ends = self.ends()
        return (ends[block - 1] if block else 0), ends[block]

    def start(self, block: Column) -> Column:
        """First position of a round given as a column."""
        if self.growth == 1:
            return block.cast("long") * self.first
        return F.get(F.array(*[F.lit(e).cast("long") for e in [0, *self.ends()]]), block)


def rounds_of(first: int | Rounds) -> Rounds:
    """A plain number stands for rounds that double."""
    return first if isinstance(first, Rounds) else Rounds(first)


def doubling_block(rank: str, first: int | Rounds) -> Column:
    """Update rounds that double in length: positions below ``first`` are round
    0, the next ``first`` are round 1, the next ``2*first`` round 2, and so on.
    Any number of rows needs only about log2(rows/first) model updates. Other
    ``Rounds`` may be given instead."""
    if isinstance(first, Rounds):
        return first.block(rank)
    q = f"(`{rank}` div {int(first)})"
    return F.expr(f"case when {q} = 0 then 0 else length(bin({q})) end")


def synthetic_time(rank: str, step_ms: int = 1000) -> Column:
    """Event time made from the arrival counter, ``step_ms`` per row."""
    return F.timestamp_millis(F.col(rank) * F.lit(step_ms))


def full_count_windows(df: DataFrame, rank: str, size: int, *aggs: Column) -> DataFrame:
    """Aggregates per count window; a last window that is not full stays out."""
    return (
        df.groupBy(fixed_block(rank, size).alias("block"))
        .agg(F.count("*").alias("n"), *aggs)
        .filter(F.col("n") == size)
    )


def doubling_bounds(block: int, first: int | Rounds) -> tuple[int, int]:
    """First position of a ``doubling_block`` round and the one behind its end."""
    if isinstance(first, Rounds):
        return first.bounds(block)
    return (0 if block == 0 else first << (block - 1)), first << block

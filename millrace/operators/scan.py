"""Running state over a global (or per-key) order without a one-task window.

``Window.orderBy(seq)`` with no partition moves the whole table into one task,
and ``partitionBy(key)`` does the same to a hot key. Here the order is cut into
blocks of ``seq div width``. Each block is first reduced to its totals with a
partial aggregate; the totals are scanned the same way one level up; and the
state that enters a block comes back as one extra *carry row* which sorts before
the block's own rows. The window over ``(keys, block)`` then needs one shuffle
and holds at most ``width`` rows, because ``order`` is unique within a key.

Only a key with more than ``HOT_ROWS`` rows is cut into blocks (without keys, a
table with more); the window of any other is small as it is. Cutting up small keys
would make a table of block totals as long as the input, and cutting up a small
table costs more in stages than its rows do.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import materialise

# Rows per block, then blocks per super-block. 10^11 rows leave about 1500
# entries for the last, unpartitioned step.
WIDTHS = (1 << 14, 1 << 12)
# A key with more rows than this is cut into blocks, and a table without keys.
HOT_ROWS = 1 << 20
# A table is counted as a whole only where Spark expects no more bytes of it.
COUNT_BYTES = 1 << 28


@dataclass(frozen=True)
class State:
    """What one row adds to a running state, and how two states combine:
    ``sum``, ``max``, ``min``, or ``last`` (latest non-null)."""

    value: Column
    how: str = "sum"


def count_state() -> State:
    return State(F.lit(1).cast("bigint"))


_OVER = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _block_total(name: str, how: str, order: str) -> Column:
    if how == "last":
        col = F.col(name)
        return F.max_by(col, F.when(col.isNotNull(), F.col(order))).alias(name)
    return _OVER[how](name).alias(name)


def _windowed(df, order, hows, keys, end):
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    return df.withColumns({c: _OVER[how](c).over(w) for c, how in hows.items()})


def _scan(df, order, hows, keys, inclusive, widths, hot=None):
    end = Window.currentRow if inclusive else -1
    if not widths:
        return _windowed(df, [order], hows, keys, end)

    block = f"_block{len(widths)}"
    carry = f"_carry{len(widths)}"
    number = F.expr(f"`{order}` div {widths[0]}")
    if hot:
        number = F.when(F.col(hot), number).otherwise(F.lit(0).cast("bigint"))
    blocked = df.withColumn(block, number)
    cut = blocked.filter(hot) if hot else blocked
    totals = cut.groupBy(*keys, block).agg(*[_block_total(c, how, order) for c, how in hows.items()])
    entering = _scan(totals, block, hows, keys, False, widths[1:]).withColumn(carry, F.lit(0))
    rows = blocked.withColumn(carry, F.lit(1)).unionByName(entering, allowMissingColumns=True)
    out = _windowed(rows, [carry, order], hows, [*keys, block], end)
    return out.filter(F.col(carry) == 1).drop(block, carry)


def _at_most(df: DataFrame, rows: int) -> bool:
    """True if ``df`` is known to have no more than ``rows`` rows. The estimate
    only tells whether counting is cheap; the count decides."""
    expected = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return expected <= COUNT_BYTES and df.count() <= rows


def _hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most rows/hot_rows of them. They
    are written out, so the join below is planned from the table's real size."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return materialise(counts.filter(F.col("_n") > hot_rows).select(*keys), "hot-keys")


def _mark_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    joined = df.join(renamed, reduce(and_, same), "left")
    return joined.drop(*[f"_hot_{k}" for k in keys]).withColumn(
        "_hot", F.coalesce("_hot", F.lit(False))
    )


def running(
    df: DataFrame,
    order: str,
    states: Mapping[str, State],
    keys: Sequence[str] = (),
    inclusive: bool = True,
    widths: Sequence[int] = WIDTHS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add one column per state, holding its value at each row in ``order``
    (``inclusive``) or just before it. ``order`` is a whole-number column,
    unique within ``keys``. The input is evaluated twice: store it first when it
    is expensive. ``hot_rows=None`` cuts every key into blocks without counting,
    for inputs that have about as many rows under each key. All ways give the same
    rows; none puts more than ``hot_rows`` or ``widths[0]`` rows into one window."""
    keys = list(keys)
    hows = {n: s.how for n, s in states.items()}
    staged = df.withColumns({name: s.value for name, s in states.items()})
    if hot_rows is not None and _at_most(df, hot_rows):
        out = _windowed(staged, [order], hows, keys, Window.currentRow if inclusive else -1)
    elif not keys or hot_rows is None:
        out = _scan(staged, order, hows, keys, inclusive, tuple(widths))
    else:
        hot = _hot_keys(df, keys, hot_rows)
        if hot.isEmpty():
            end = Window.currentRow if inclusive else -1
            out = _windowed(staged, [order], hows, keys, end)
        else:
            marked = _mark_hot(staged, hot, keys)
            out = _scan(marked, order, hows, keys, inclusive, tuple(widths), "_hot").drop("_hot")
    zero = {n: F.coalesce(F.col(n), F.lit(0)) for n, s in states.items() if s.how == "sum"}
    return out.withColumns(zero) if zero else out


# A state that has shrunk by this factor no longer changes a double.
NOTHING_LEFT = 1e-100


def decayed(
    df: DataFrame,
    order: str,
    value: Column,
    factor: float,
    name: str,
    keys: Sequence[str] = (),
    max_rows: int = WIDTHS[0],
) -> DataFrame:
    """Add the running state ``s = factor * s + value`` with ``0 < factor < 1``.
    ``order`` is a gapless 0-based position per key; a null value adds nothing.

    A block acts on the state as one affine map: all blocks multiply by
    ``factor^width`` and each adds its own end value. The state that leaves the
    blocks is the same kind of scan over them, so no window holds more than
    ``max_rows`` rows for any factor; levels end where ``factor^width`` leaves
    nothing of an older state (three for a factor of 0.999999)."""
    if not 0.0 < factor < 1.0:
        raise ValueError("factor must lie between 0 and 1")
    staged = df.withColumn(name, F.coalesce(value.cast("double"), F.lit(0.0)))
    return _decayed(staged, order, factor, name, list(keys), max_rows, 0)


def _decayed(df, order, factor, name, keys, max_rows, level):
    block, pos, carry = f"_block{level}", f"_pos{level}", f"_enters{level}"
    # weights within a block stay within a double
    width = max(1, min(max_rows, math.ceil(math.log10(NOTHING_LEFT) / math.log10(factor))))
    through = factor**width
    blocked = df.withColumn(block, F.expr(f"`{order}` div {width}")).withColumn(
        pos, (F.col(order) - F.col(block) * width).cast("int")
    )
    left = F.pow(F.lit(factor), F.lit(width - 1) - F.col(pos))
    ends = blocked.groupBy(*keys, block).agg(F.sum(F.col(name) * left).alias(carry))
    if through > NOTHING_LEFT:
        ends = _decayed(ends, block, through, carry, keys, max_rows, level + 1)
        ends = ends.withColumn("_ahead", F.lit(1))
    else:
        # one more block back, for weights just above the border
        ends = ends.withColumn("_ahead", F.explode(F.array(F.lit(1), F.lit(2))))
        older = F.when(F.col("_ahead") == 2, F.lit(through)).otherwise(1.0)
        ends = ends.withColumn(carry, F.col(carry) * older)
    entering = ends.select(
        *keys,
        (F.col(block) + F.col("_ahead")).alias(block),
        F.lit(-1).alias(pos),
        (F.col(carry) * factor).alias(carry),
    )
    rows = blocked.unionByName(entering, allowMissingColumns=True)
    w = Window.partitionBy(*keys, block).orderBy(pos).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    decay = F.pow(F.lit(factor), F.col(pos))
    state = F.coalesce(F.sum(carry).over(w), F.lit(0.0)) + F.sum(F.col(name) / decay).over(w)
    return (
        rows.withColumn(name, state * decay).filter(F.col(pos) >= 0).drop(block, pos, carry)
    )

"""Event-time windows over bounded data, and the late-row audit.

Sliding windows overlap, so a row belongs to ``size/slide`` of them. Everything
that can be combined is reduced per *pane* (the common divisor of size and slide)
first, and only panes are copied to windows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.scan import WIDTHS, State, running


def _seconds(ts: str) -> Column:
    """Whole epoch seconds of a timestamp with or without zone."""
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def pane_seconds(size: int, slide: int) -> int:
    return math.gcd(size, slide)


def _pane(ts: str, size: int, slide: int) -> Column:
    p = pane_seconds(size, slide)
    return (F.floor(_seconds(ts) / p) * p).cast("bigint")


def _window_starts(pane: Column, size: int, slide: int) -> Column:
    """Start seconds of all windows that contain the pane."""
    newest = (F.floor(pane / slide) * slide).cast("bigint")
    reach = (math.ceil(size / slide) - 1) * slide
    starts = F.sequence(newest, newest - reach, F.lit(-slide).cast("bigint"))
    return F.filter(starts, lambda s: s + size > pane)


def window_members(df: DataFrame, ts: str, size: int, slide: int) -> DataFrame:
    """Every (window, row) pair in long form: a projection, no shuffle, and no
    window is ever held as one list. Sizes are in seconds."""
    starts = _window_starts(_pane(ts, size, slide), size, slide)
    return df.withColumn("window_start", F.explode(starts)).withColumn(
        "window_end", F.col("window_start") + size
    )


def window_counts(df: DataFrame, ts: str, size: int, slide: int) -> DataFrame:
    """Rows per window from rows per pane."""
    panes = df.groupBy(_pane(ts, size, slide).alias("_pane")).agg(F.count("*").alias("_n"))
    wide = panes.withColumn(
        "window_start", F.explode(_window_starts(F.col("_pane"), size, slide))
    )
    return wide.groupBy("window_start").agg(F.sum("_n").alias("n"))


def flatten_windows(
    df: DataFrame,
    ts: str,
    seq: str,
    features: str,
    targets: str,
    size: int,
    slide: int,
    rows: int,
) -> tuple[DataFrame, DataFrame]:
    """Windows as single feature vectors, and the windows that have too few rows.

    The first ``rows`` rows of a window in (time, arrival) order are put end to
    end; the targets are those of the last of them. Only the first ``rows`` rows
    of a pane can matter, and that limit is applied before the shuffle, so a
    crowded pane costs no more than ``rows`` rows per task.
    """
    first = Window.partitionBy("_pane").orderBy(ts, seq)
    pane_heads = (
        df.select(ts, seq, features, targets, _pane(ts, size, slide).alias("_pane"))
        .withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= rows)
    )
    member = F.struct(F.col(ts), F.col(seq), F.col(features).alias("f"), F.col(targets).alias("t"))
    built = (
        pane_heads.withColumn(
            "window_start", F.explode(_window_starts(F.col("_pane"), size, slide))
        )
        .groupBy("window_start")
        .agg(F.slice(F.sort_array(F.collect_list(member)), 1, rows).alias("_m"))
    )
    counts = window_counts(df, ts, size, slide)
    full = built.filter(F.size("_m") >= rows).select(
        "window_start",
        F.flatten(F.transform("_m", lambda m: m["f"])).alias("features"),
        F.element_at("_m", rows)["t"].alias("targets"),
    )
    full = full.join(counts, "window_start").withColumn("overflow", F.col("n") - rows)
    short = counts.filter(F.col("n") < rows).withColumn("window_end", F.col("window_start") + size)
    return full, short


def tumbling(
    df: DataFrame, ts: str, size: int, aggs: Sequence[Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregates per window of ``size`` seconds."""
    start = (F.floor(_seconds(ts) / size) * size).cast("bigint")
    return df.groupBy(start.alias("window_start"), *keys).agg(*aggs)


def window_vector_average(
    df: DataFrame, ts: str, vector: str, size: int, slide: int
) -> DataFrame:
    """Element-wise mean of a vector over sliding windows: sums and counts per
    pane and element, then per window."""
    panes = (
        df.select(_pane(ts, size, slide).alias("_pane"), F.posexplode(vector).alias("i", "_x"))
        .groupBy("_pane", "i")
        .agg(F.sum("_x").alias("_s"), F.count("_x").alias("_n"))
    )
    return (
        panes.withColumn("window_start", F.explode(_window_starts(F.col("_pane"), size, slide)))
        .groupBy("window_start", "i")
        .agg((F.sum("_s") / F.sum("_n")).alias("mean"), F.sum("_n").alias("n"))
    )


def late_rows(
    df: DataFrame, ts: str, order: str, delay_seconds: int, widths: Sequence[int] = WIDTHS
) -> DataFrame:
    """Rows older than the watermark that the rows before them had set: the
    largest earlier event time minus the allowed delay."""
    out = running(df, order, {"_seen": State(F.col(ts), "max")}, inclusive=False, widths=widths)
    mark = F.col("_seen") - F.make_dt_interval(secs=F.lit(float(delay_seconds)))
    return out.filter(F.col(ts) < mark).drop("_seen")

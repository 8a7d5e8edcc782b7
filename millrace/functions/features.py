"""Column expressions for feature preparation. Everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unquote(col: Column, quote: str = "'") -> Column:
    return F.replace(col, F.lit(quote), F.lit(""))


def parse_double(col: Column, quote: str = "'") -> Column:
    """Number in a text cell, NULL where it is not one."""
    return unquote(F.trim(col), quote).try_cast("double")


def split_rejected(
    df: DataFrame, columns: Sequence[str], quote: str = "'"
) -> tuple[DataFrame, DataFrame]:
    """Rows whose text cells all parse, and the rest unchanged with the number
    of bad cells. Nothing is dropped between the two."""
    bad = sum(
        (parse_double(F.col(c), quote).isNull().cast("int") for c in columns), start=F.lit(0)
    )
    counted = df.withColumn("bad_cells", bad)
    good = (
        counted.filter("bad_cells = 0")
        .drop("bad_cells")
        .withColumns({c: parse_double(F.col(c), quote) for c in columns})
    )
    return good, counted.filter("bad_cells > 0")


# --- labels -----------------------------------------------------------------


def equals_label(col: Column, positive=1) -> Column:
    """0 for the positive value, 1 for every other."""
    return F.when(col == positive, 0).otherwise(1)


def zero_based_label(col: Column) -> Column:
    return (col - 1).cast("int")


def threshold_label(col: Column, limit: float) -> Column:
    """0 up to and including the limit, 1 above it."""
    return F.when(col <= limit, 0).otherwise(1)


def bin_levels(col: Column, warning: float, alarm: float) -> Column:
    """2 from the alarm level, 1 from the warning level, else 0; NULL stays."""
    return F.when(col >= alarm, 2).when(col >= warning, 1).when(col.isNotNull(), 0)


# --- vectors ----------------------------------------------------------------


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("double")


def one_hot(col: Column, vocabulary: Sequence[str]) -> Column:
    """One slot per vocabulary word; an unknown or NULL value fills none."""
    words = F.array(*[F.lit(v) for v in vocabulary])
    return F.transform(words, lambda v: _flag(v == col))


def one_hot_ordinal(col: Column, size: int) -> Column:
    """One slot per ordinal 1..size; anything else fills none."""
    return F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: _flag(i == col))


def ordinal_out_of_range(col: Column, size: int) -> Column:
    return F.coalesce(~col.between(1, size), F.lit(True))


def vector(columns: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.array(*[c.cast("double") for c in cols])


def normalise(vec: Column, norms: Sequence[float]) -> Column:
    return F.zip_with(vec, F.array(*[F.lit(float(n)) for n in norms]), lambda x, n: x / n)


def scale(vec: Column, divisor: float) -> Column:
    return F.transform(vec, lambda x: x / F.lit(float(divisor)))


def expand_slot(vec: Column, index: int, size: int, first: int = 0) -> Column:
    """Replace the 0-based slot ``index`` by ``size`` one-hot slots for the codes
    ``first..first+size-1``; the slots behind it move right."""
    code = F.get(vec, F.lit(index)).cast("int")
    hot = F.transform(
        F.sequence(F.lit(first), F.lit(first + size - 1)), lambda i: _flag(i == code)
    )
    # a slice may start one past the end, never two
    rest = F.slice(vec, index + 2, F.greatest(F.size(vec) - (index + 1), F.lit(0)))
    return F.concat(F.slice(vec, 1, index), hot, rest)


def pad(vec: Column, width: int) -> Column:
    """Zeros up to ``width``; a vector that is already wider is an error."""
    missing = F.lit(width) - F.size(vec)
    fill = F.array_repeat(F.lit(0.0), F.greatest(missing, F.lit(0)).cast("int"))
    return F.when(missing >= 0, F.concat(vec, fill)).otherwise(
        F.raise_error(F.concat(F.lit(f"vector wider than {width}: "), F.size(vec).cast("string")))
    )


def event_time(year, month, day, hour, minute, second) -> Column:
    """Event time from six numeric columns, in the session zone (UTC)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (year, month, day, hour, minute)]
    sec = F.col(second) if isinstance(second, str) else second
    return F.make_timestamp(*[p.cast("int") for p in parts], sec.cast("int").cast("decimal(16,6)"))


# --- votes ------------------------------------------------------------------


def arg_max(votes: Column) -> Column:
    """0-based index of the highest vote, the first one on a tie."""
    return (F.array_position(votes, F.array_max(votes)) - 1).cast("int")


def binary_vote(votes: Column) -> Column:
    return F.get(votes, F.lit(0)) >= F.get(votes, F.lit(1))


def flags_to_features(flags: Column) -> Column:
    return F.transform(flags, lambda f: f.cast("double"))


def is_mismatch(actual: str, label: str) -> Column:
    """Whether the carried label no longer agrees with the instance's own."""
    return ~F.col(actual).eqNullSafe(F.col(label))


def label_mismatch(df: DataFrame, actual: str, label: str) -> DataFrame:
    return df.filter(is_mismatch(actual, label))


def one_row_per_output(df: DataFrame, actual: str, pred: str, keep: Sequence[str]) -> DataFrame:
    """A row with k outputs becomes k rows ``(output, actual, pred)``."""
    pairs = F.arrays_zip(F.col(actual).alias("actual"), F.col(pred).alias("pred"))
    return df.select(*keep, F.posexplode(pairs).alias("output", "_p")).select(
        *keep, "output", F.col("_p.actual").alias("actual"), F.col("_p.pred").alias("pred")
    )


def output_tag(output: Column, level: Column) -> Column:
    return F.concat_ws("-", output.cast("string"), level.cast("string"))


def key_text(key: Column, text: Column) -> Column:
    return F.format_string("KEY_%s - %s", key.cast("string"), text)

"""Reading rows in: headerless text, literals, sequences, and arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.order import synthetic_time, with_rank


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, quote: str | None = None
) -> DataFrame:
    """Headerless comma-separated rows with a declared schema. Cells that do not
    fit the type become NULL; read them as text and use ``split_rejected`` to
    report them."""
    reader = spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE")
    if quote is not None:
        reader = reader.option("quote", quote)
    return reader.csv(path)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    quote: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same rows as a stream over the files of a folder."""
    reader = spark.readStream.schema(schema).option("header", False)
    if quote is not None:
        reader = reader.option("quote", quote)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, first: int, last: int, name: str = "id") -> DataFrame:
    """Whole numbers ``first..last``, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def line_order(df: DataFrame, name: str = "seq") -> DataFrame:
    """Gapless line numbers for a text source that carries none: files by path,
    lines in the order of the file.

    Every file split counts its lines; the running total over splits gives each
    split its first number. Only the split table (one row per ~128 MB) is put in
    order; rows are numbered where they are read.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"),
    )
    splits = placed.groupBy("_file", "_split").agg(
        F.count("*").alias("_n"), F.min("_line").alias("_first")
    )
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_file", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        placed.join(starts, ["_file", "_split"])
        .withColumn(name, F.col("_start") + F.col("_line") - F.col("_first"))
        .drop("_file", "_split", "_line", "_first", "_start")
    )


def train_and_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same source as two streams of one plan; the scan's exchange is shared
    where both ask for the same columns."""
    return df.withColumn("role", F.lit("train")), df.withColumn("role", F.lit("test"))


def with_synthetic_time(
    df: DataFrame, order: str, step_ms: int = 1000, dense_from: int | None = None
) -> DataFrame:
    """Arrival counter and the event time made from it."""
    ranked = with_rank(df, order, name="_rank", dense_from=dense_from)
    return ranked.withColumn("seq", F.col("_rank") + 1).withColumn(
        "event_time", synthetic_time("seq", step_ms)
    ).drop("_rank")

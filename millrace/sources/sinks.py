"""Writing rows out."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_folder(base: str, started: datetime) -> str:
    """Output folder named after the start of the run."""
    return f"{base.rstrip('/')}/output-{started:%Y-%m-%d_%H-%M-%S}"


def write_csv(df: DataFrame, path: str) -> str:
    """One headerless file per task."""
    df.write.option("header", False).csv(path)
    return path


def write_named_outputs(df: DataFrame, path: str, tag: str = "tag") -> str:
    """All named outputs in one pass over ``df``, one sub-folder per tag."""
    df.write.partitionBy(tag).parquet(path)
    return path


def tagged(df: DataFrame, outputs: Mapping[str, Column], default: str = "main") -> DataFrame:
    """Copies of each row, one for the main output and one for every named
    output whose condition holds. Consumers filter on ``tag``."""
    tags = [F.lit(default)] + [F.when(cond, F.lit(name)) for name, cond in outputs.items()]
    return df.withColumn("tag", F.explode(F.array_compact(F.array(*tags))))


def output(df: DataFrame, name: str, tag: str = "tag") -> DataFrame:
    return df.filter(F.col(tag) == name).drop(tag)

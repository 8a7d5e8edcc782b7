"""Side-by-side run of a query in Spark and its SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from millrace.learners import bayes

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "HUGEINT": "int",
    "double": "float", "float": "float", "DOUBLE": "float", "FLOAT": "float",
    "string": "text", "VARCHAR": "text", "boolean": "bool", "BOOLEAN": "bool",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows_of(rows, names):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in at) for r in rows)


def difference(spark, fn, sql: str, sf_dir: str, con) -> str | None:
    """None when both give the same rows, else what differs."""
    df = fn(spark, sf_dir)
    left = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    right = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    types = dict(zip(names, [str(t[1]) for t in res.description]))
    for f in df.schema.fields:
        want = KINDS.get(f.dataType.simpleString())
        if want is None:
            return f"type of {f.name}: {f.dataType.simpleString()} / {types[f.name]}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    a, b = rows_of(left, df.columns), rows_of(right, names)
    if a != b:
        return f"values differ in {sum((a - b).values())} rows: {list((a - b).items())[:3]} / {list((b - a).items())[:3]}"
    return None


def bayes_by_join(df, models, block, features, width):
    """Scores of naive Bayes as column expressions, each row with its own model."""
    joined = df.join(bayes.packed(models), block, "left")
    pred = bayes.predicted(F.col("params"), F.col(features), width)
    return joined.withColumn("pred", pred).drop("params")

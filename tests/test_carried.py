import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.carried import matrix_of, score_carried


def test_matrix_of_ragged_missing_and_sliced():
    rows = [[1.0, 2.0], None, [3.0], [4.0, None, 9.0], []]
    want = [[1, 2], [np.nan] * 2, [3, np.nan], [4, np.nan], [np.nan] * 2]
    both = pa.array(rows, pa.list_(pa.float64()))
    assert np.array_equal(matrix_of(both, 2), want, equal_nan=True)
    assert np.array_equal(matrix_of(both.slice(2), 2), want[2:], equal_nan=True)
    whole = pa.array([[1, 2], [3, 4], [5, 6]], pa.list_(pa.int32())).slice(1, 1)
    assert matrix_of(whole, 2).tolist() == [[3, 4]]
    assert matrix_of(both.slice(0, 0), 2).shape == (0, 2)


def adder():
    def work(model, rows):
        return pa.array(rows.column(1).to_numpy() + model.as_py())

    return work  # an inner function travels to the tasks by value


@pytest.mark.parametrize("slice_rows", [1 << 14, 10])
def test_hot_groups_are_sliced_and_null_and_unknown_groups_kept(spark, slice_rows):
    # one group holds a third of the rows; group 4 has no model, one group is null
    rows = [(None if i % 7 == 0 else 0 if i % 3 == 0 else 1 + i % 4, i, 2**60 + i if i % 2 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "g long, seq long, kept long").repartition(3)
    models = spark.createDataFrame([(g, g * 1000) for g in (0, 1, 2, 3, 77)] + [(None, -5)], "g long, m long")
    out = score_carried(df, models, ["g"], "m", adder(), "s", T.IntegerType(), -1, slice_rows=slice_rows)
    assert out.columns == ["g", "seq", "kept", "s"]
    got = sorted((r["seq"], r["g"], r["kept"], r["s"]) for r in out.collect())
    value = {None: -5, 0: 0, 1: 1000, 2: 2000, 3: 3000}
    assert got == [(i, g, k, i + value[g] if g in value else -1) for g, i, k in rows]
    gated = score_carried(df, models, ["g"], "m", adder(), "s", T.IntegerType(), gate=True, slice_rows=slice_rows)
    assert gated.count() == sum(g in value for g, _, _ in rows)
    assert gated.filter(F.col("g") == 4).count() == 0


def test_no_task_gets_a_whole_hot_group(spark):
    df = spark.range(4000).select(F.lit(1).alias("g"), "id")
    models = spark.createDataFrame([(1, 0)], "g int, m int")
    out = score_carried(df, models, ["g"], "m", adder(), "s", T.IntegerType(), slice_rows=100)
    tasks = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert out.count() == 4000 and tasks < 2000


def test_empty_rows_and_empty_models(spark):
    df = spark.createDataFrame([(1, 5)], "g int, id long")
    models = spark.createDataFrame([], "g int, m int")
    out = score_carried(df, models, ["g"], "m", adder(), "s", T.IntegerType(), 9)
    assert [tuple(r) for r in out.collect()] == [(1, 5, 9)]
    none = score_carried(df.limit(0), models, ["g"], "m", adder(), "s", T.IntegerType(), 9)
    assert none.count() == 0

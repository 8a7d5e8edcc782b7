"""Empty tables, NULLs and keys seen once."""

import pytest
from compare import bayes_by_join
from pyspark.sql import functions as F

from millrace.learners import bayes, ensemble
from millrace.learners.network import Network, train_in_rounds
from millrace.learners.tree import TreeParams, prequential_hoeffding
from millrace.operators import connect, metrics, windows
from millrace.operators.order import fixed_block, number_by, with_rank


def empty(spark):
    return spark.createDataFrame(
        [], "seq long, k string, ts timestamp, x array<double>, y array<double>, label int"
    )


def test_empty_tables_give_empty_results(spark):
    df = empty(spark)
    right = F.col("label") == 1
    assert metrics.prequential_accuracy(df, "seq", right).count() == 0
    assert metrics.ewma_accuracy(df, "seq", right, 0.5).count() == 0
    assert metrics.accuracy_progress(df, "seq", right, 10).count() == 0
    full, short = windows.flatten_windows(df, "ts", "seq", "x", "y", 10, 5, 3)
    assert full.count() == 0 and short.count() == 0
    assert number_by(df.select("seq", "k"), ["k", "seq"]).count() == 0
    blocked = df.withColumn("b", fixed_block("seq", 10))
    assert bayes.prequential_naive_bayes(blocked, "b", "x", "label", 2, (0, 1)).count() == 0
    assert train_in_rounds(df, "seq", "x", "y", Network((2, 1))).count() == 0
    assert prequential_hoeffding(df, "seq", "x", "label", TreeParams(2, 2)).count() == 0
    snaps = ensemble.majority_snapshots(df, "seq", "label", (0, 1), 10)
    assert connect.with_latest(df.select("seq"), "seq", {"m": snaps}).count() == 0
    grid = metrics.confusion_matrix(df, F.col("label"), F.col("label"), 3)
    assert grid.count() == 9 and grid.agg(F.sum("n")).first()[0] == 0


def test_null_features_and_labels_are_scored_but_not_counted(spark):
    rows = [(i, [float(i % 5), None if i % 7 == 0 else 1.0], None if i % 11 == 0 else i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int")
    p = TreeParams(2, 2, split_confidence=0.1, grace=20)
    out = prequential_hoeffding(df, "seq", "x", "label", p, first=32)
    assert out.count() == 200 and out.filter("pred is null").count() == 0


def test_bayes_with_missing_vectors_elements_and_labels(spark):
    rows = [
        (i, None if i % 16 == 3 else [float(i % 2), None if i % 9 == 0 else 1.0 + i % 3],
         None if i % 13 == 0 else i % 2)
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int").repartition(3)
    df = df.withColumn("b", fixed_block("seq", 20))
    models = bayes.snapshots(df, "b", "x", "label", 2, (0, 1))
    a = {r["seq"]: r["pred"] for r in bayes_by_join(df, models, "b", "x", 2).collect()}
    b = {r["seq"]: r["pred"] for r in bayes.score_blocks(df, models, "b", "x", 2).collect()}
    assert a == b and len(a) == 120 and None not in a.values()
    whole = [i for i in range(40, 120) if i % 16 != 3 and i % 9]
    assert all(a[i] == i % 2 for i in whole)


def test_keys_seen_once(spark):
    rows = [(i, f"k{i}", i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "seq long, k string, label int")
    out = metrics.warmup_accuracy(df, "seq", F.col("label") == 0, 2, ["k"])
    assert out.count() == 0
    once = metrics.warmup_accuracy(df, "seq", F.col("label") == 0, 1, ["k"])
    assert once.count() == 20 and {r["seen"] for r in once.collect()} == {1}


@pytest.mark.parametrize("seqs", [[0, 1, 3], [0, 1, 1, 3], [1, 2, 3], [0, 1, None], [0, 0, 0]])
def test_a_counter_with_gaps_is_not_taken_for_dense(spark, seqs):
    rows = spark.createDataFrame([(s,) for s in seqs], "seq long")
    with pytest.raises(ValueError, match="gapless"):
        with_rank(rows, "seq", dense_from=0)
    assert with_rank(rows.limit(0), "seq", dense_from=0).count() == 0

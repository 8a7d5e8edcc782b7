import pytest
from pyspark.sql import functions as F

from millrace.operators import metrics
from millrace.operators.scan import decayed


def hits(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "rank long, c int").repartition(3)


@pytest.mark.parametrize(
    "bias, corrected", [("squaring", [1, 1 / 3, 2 / 3]), ("power", [1, 1 / 3, 0.625 / 0.875])]
)
def test_weighted_accuracy_golden(spark, bias, corrected):
    out = metrics.ewma_accuracy(hits(spark, [1, 0, 1]), "rank", F.col("c") == 1, 0.5, bias)
    rows = out.orderBy("rank").collect()
    assert [r["raw"] for r in rows] == pytest.approx([0.5, 0.25, 0.625])
    assert [r["corrected"] for r in rows] == pytest.approx(corrected)


@pytest.mark.parametrize("alpha", [0.02, 0.5, 0.9, 0.999, 0.999999])
def test_weighted_accuracy_equals_a_loop(spark, alpha):
    values = [(i * 7 + i // 3) % 5 > 1 for i in range(1500)]
    values[300:900] = [False] * 600
    out = metrics.ewma_accuracy(
        hits(spark, [int(v) for v in values]), "rank", F.col("c") == 1, alpha
    )
    a, want = 0.0, []
    for v in values:
        a = alpha * a + (1 - alpha) * v
        want.append(a)
    got = [r["raw"] for r in out.orderBy("rank").collect()]
    assert got == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("factor, max_rows", [(0.999999, 128), (0.9, 16), (0.001, 16), (0.97, 1 << 14)])
def test_decayed_state_over_several_levels_equals_a_loop(spark, factor, max_rows):
    values = [None if i % 11 == 0 else ((i * 7 + i // 3) % 5 - 1) * 0.5 for i in range(1500)]
    rows = [(k, i, v) for k in ("a", None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, rank long, v double").repartition(3)
    out = decayed(df, "rank", F.col("v"), factor, "s", ["k"], max_rows)
    assert sorted(out.columns) == ["k", "rank", "s", "v"]
    s, want = 0.0, []
    for v in values:
        s = factor * s + (v or 0.0)
        want.append(s)
    got = out.orderBy("rank").collect()
    for key in ("a", None):
        assert [r["s"] for r in got if r["k"] == key] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_weighted_accuracy_per_key(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 1, 0), (None, 0, 0), (None, 1, 1)], "k string, rank long, c int"
    )
    out = metrics.ewma_accuracy(df, "rank", F.col("c") == 1, 0.5, keys=["k"])
    got = {(r["k"], r["rank"]): r["raw"] for r in out.collect()}
    assert got == {("a", 0): 0.5, ("a", 1): 0.25, (None, 0): 0.0, (None, 1): 0.5}


def test_progress_has_no_partial_line(spark):
    out = metrics.accuracy_progress(hits(spark, [1, 1, 0, 1, 1]), "rank", F.col("c") == 1, 2)
    got = [(r["seen"], r["hits"], r["accuracy"]) for r in out.orderBy("seen").collect()]
    assert got == [(2, 2, 1.0), (4, 3, 0.75)]


def test_warmup(spark):
    out = metrics.warmup_accuracy(hits(spark, [1, 0, 1, 1]), "rank", F.col("c") == 1, 3)
    got = [(r["seen"], r["accuracy"]) for r in out.orderBy("rank").collect()]
    assert got == [(3, 1.0), (4, 1.0)]


def test_confusion_keeps_published_totals_and_zero_cells(spark):
    # pair counts of the longer published run
    cells = {(0, 0): 1112986, (0, 1): 207, (0, 2): 715, (1, 0): 6, (2, 0): 157, (2, 1): 4, (2, 2): 37}
    df = None
    for (a, p), n in cells.items():
        part = spark.range(n).select(F.lit(a).alias("a"), F.lit(p).alias("p"))
        df = part if df is None else df.unionByName(part)
    got = {(r["actual"], r["pred"]): r["n"] for r in metrics.confusion_matrix(df, F.col("a"), F.col("p"), 3).collect()}
    assert got == {(a, p): cells.get((a, p), 0) for a in range(3) for p in range(3)}


def test_confusion_leaves_out_nulls_and_counts_them(spark):
    df = spark.createDataFrame([(0, 0), (None, 1), (2, None)], "a int, p int")
    got = metrics.confusion_matrix(df, F.col("a"), F.col("p"), 3).agg(F.sum("n")).first()[0]
    assert got == 1
    assert metrics.unpaired_count(df, F.col("a"), F.col("p")).first()["n"] == 2


def test_vector_average_of_groups(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [5.0, 5.0])], "k string, v array<double>")
    got = {r["k"]: (r["n"], list(r["mean"])) for r in metrics.vector_average(df, "v", ["k"]).collect()}
    assert got == {"a": (2, [2.0, 4.0]), "b": (1, [5.0, 5.0])}

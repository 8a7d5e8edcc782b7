import pytest
from pyspark.sql import functions as F

from millrace.operators import connect, keyed, windows


def test_rolling_max_golden(spark):
    rows = [(0, 1, 2), (1, 1, 3), (2, 2, 2), (3, 3, 1)]
    df = spark.createDataFrame(rows, "seq long, k int, v int")
    out = keyed.rolling_max_by(df, ["k"], "seq", "v")
    assert sorted((r["top_k"], r["top_v"]) for r in out.collect()) == [(1, 2), (1, 3), (2, 2), (3, 1)]


def test_rolling_max_tie_keeps_the_earlier_row(spark):
    df = spark.createDataFrame([(0, 1, 5), (1, 1, 5), (2, 1, 4)], "seq long, k int, v int")
    out = keyed.rolling_max_by(df, ["k"], "seq", "v")
    assert [r["top_seq"] for r in out.orderBy("seq").collect()] == [0, 0, 0]
    assert keyed.final_max_by(df, ["k"], "seq", "v").first()["seq"] == 0


def test_union_of_multiples(spark):
    base = spark.range(1, 101)
    out = base.unionByName(base.select((F.col("id") * 2).alias("id"))).unionByName(
        base.select((F.col("id") * 4).alias("id"))
    )
    assert out.agg(F.count("*"), F.sum("id")).first() == (300, 35350)


@pytest.mark.parametrize("widths", [(4, 2), (100,)])
def test_latest_snapshot(spark, widths):
    rows = spark.range(20).withColumnRenamed("id", "seq")
    a = spark.createDataFrame([(3, "a3"), (11, "a11")], "valid_from long, params string")
    b = spark.createDataFrame([(0, "b0"), (19, "b19")], "valid_from long, params string")
    out = connect.with_latest(rows, "seq", {"a": a, "b": b}, widths=widths)
    got = {r["seq"]: (r["a"], r["b"]) for r in out.collect()}
    for s in range(20):
        want_a = None if s < 3 else "a3" if s < 11 else "a11"
        assert got[s] == (want_a, "b19" if s == 19 else "b0")
    gated = connect.with_latest(rows, "seq", {"a": a, "b": b}, gate=True, widths=widths)
    assert sorted(r["seq"] for r in gated.collect()) == list(range(3, 20))


def test_flags_vote_or_correct(spark):
    df = spark.createDataFrame([([3, 1], 1), ([2, 2], 0), ([0, 5], 1)], "m array<long>, label int")
    vote = connect.append_flags(df, [F.col("m")]).collect()
    assert [r["flags"] for r in vote] == [[True], [True], [False]]
    right = connect.append_flags(df, [F.col("m")], "label", "correct").collect()
    assert [r["flags"] for r in right] == [[False], [True], [True]]
    with pytest.raises(ValueError):
        connect.append_flags(df, [F.col("m")], kind="other")


def test_gather_reports_missing_models(spark):
    df = spark.createDataFrame(
        [(1, 0, 5.0, 1.0), (1, 1, 6.0, 1.0), (2, 1, 7.0, 0.0)],
        "seq long, model_idx int, pred double, actual double",
    )
    out = connect.gather(df, 2)
    got = {r["seq"]: (list(r["features"]), r["complete"]) for r in out.collect()}
    assert got == {1: ([5.0, 6.0], True), 2: ([0.0, 7.0], False)}
    assert [r["seq"] for r in connect.incomplete(out).collect()] == [2]


def stamped(spark, rows):
    df = spark.createDataFrame(rows, "seq long, sec long, x double")
    return df.select(
        "seq",
        F.timestamp_seconds("sec").alias("ts"),
        F.array("x", F.col("x") * 10).alias("f"),
        F.array("x").alias("t"),
    )


def test_flattened_windows_short_exact_and_overfull(spark):
    # window [0,3): two rows, [3,6): three rows, [6,9): four rows, duplicate times
    rows = [(0, 0, 1.0), (1, 2, 2.0), (2, 3, 3.0), (3, 4, 4.0), (4, 5, 5.0)]
    rows += [(8, 8, 9.0), (5, 6, 6.0), (7, 6, 8.0), (6, 6, 7.0)]
    full, short = windows.flatten_windows(stamped(spark, rows), "ts", "seq", "f", "t", 3, 3, 3)
    got = {r["window_start"]: (list(r["features"]), list(r["targets"]), r["n"]) for r in full.collect()}
    assert got[3] == ([3, 30, 4, 40, 5, 50], [5.0], 3)
    assert got[6] == ([6, 60, 7, 70, 8, 80], [8.0], 4)
    assert [(r["window_start"], r["n"]) for r in short.collect()] == [(0, 2)]


def test_crowded_panes_are_cut_before_the_shuffle(spark):
    full, _ = windows.flatten_windows(stamped(spark, [(0, 0, 1.0)]), "ts", "seq", "f", "t", 3, 1, 3)
    assert "WindowGroupLimit" in full._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size, slide", [(6, 2), (5, 2), (4, 4), (7, 3)])
def test_sliding_members_equal_the_built_in_window(spark, size, slide):
    df = stamped(spark, [(i, i * 3 % 17, 1.0) for i in range(17)])
    ours = windows.window_members(df, "ts", size, slide).select("seq", "window_start")
    theirs = df.select("seq", F.window("ts", f"{size} seconds", f"{slide} seconds").alias("w")).select(
        "seq", F.unix_seconds("w.start").alias("window_start")
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    counts = windows.window_counts(df, "ts", size, slide)
    assert counts.agg(F.sum("n")).first()[0] == ours.count()


def test_windows_with_gaps_between_them(spark):
    df = stamped(spark, [(i, i, 1.0) for i in range(12)])
    got = {(r["seq"], r["window_start"]) for r in windows.window_members(df, "ts", 2, 3).collect()}
    assert got == {(i, i - i % 3) for i in range(12) if i % 3 < 2}


def test_late_rows(spark):
    df = stamped(spark, [(0, 100, 1.0), (1, 95, 1.0), (2, 89, 1.0), (3, 200, 1.0), (4, 150, 1.0)])
    late = windows.late_rows(df, "ts", "seq", 10, widths=(2, 2))
    assert sorted(r["seq"] for r in late.collect()) == [2, 4]


def test_a_repeated_prediction_is_no_other_model(spark):
    from millrace.operators.connect import gather

    rows = [(1, 0, 1.0, 1), (1, 0, 0.0, 1), (2, 0, 1.0, 0), (2, 1, 1.0, 0)]
    got = gather(spark.createDataFrame(rows, "seq long, model_idx int, pred double, actual int"), 2)
    assert {r.seq: r.complete for r in got.collect()} == {1: False, 2: True}

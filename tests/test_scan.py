import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.order import (
    doubling_block,
    doubling_bounds,
    full_count_windows,
    number_by,
    with_rank,
)
from millrace.operators.scan import State, count_state, running


def sample(n=500, seed=1):
    rng = np.random.default_rng(seed)
    # gaps in the order, one hot key, a NULL key
    order = np.sort(rng.choice(n * 20, n, replace=False))
    key = rng.choice(["hot", "hot", "hot", "a", "b", None], n)
    value = rng.integers(-50, 50, n).astype(float)
    value[rng.random(n) < 0.1] = np.nan
    return pd.DataFrame({"seq": order, "k": key, "v": value}).sample(frac=1, random_state=seed)


def frame(spark, pdf, parts=5):
    rows = [
        (int(s), k, None if np.isnan(v) else float(v)) for s, k, v in pdf.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, "seq long, k string, v double").repartition(parts)


def states():
    return {
        "n": count_state(),
        "total": State(F.col("v")),
        "top": State(F.col("v"), "max"),
        "low": State(F.col("v"), "min"),
        "prev": State(F.col("v"), "last"),
    }


def expected(pdf, keyed, inclusive):
    out = {}
    groups = pdf.groupby("k", dropna=False) if keyed else [(None, pdf)]
    for _, g in groups:
        seen = []
        for s, _, v in g.sort_values("seq").itertuples(index=False):
            if inclusive:
                seen.append(v)
            real = [x for x in seen if not np.isnan(x)]
            out[int(s)] = (
                len(seen),
                sum(real),
                max(real) if real else None,
                min(real) if real else None,
                real[-1] if real else None,
            )
            if not inclusive:
                seen.append(v)
    return out


@pytest.mark.parametrize("widths", [(7, 3), (64,), (10_000, 5)])
@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("hot_rows", [0, 120, 1000, None])
def test_running_equals_a_loop(spark, widths, keyed, inclusive, hot_rows):
    pdf = sample()
    # 'hot' holds about half of the rows; at 120 it alone is cut into blocks, without
    # keys the whole table is; a table of unknown size is not counted
    out = running(
        frame(spark, pdf), "seq", states(), ["k"] if keyed else [], inclusive, widths, hot_rows
    )
    got = {r["seq"]: (r["n"], r["total"], r["top"], r["low"], r["prev"]) for r in out.collect()}
    want = expected(pdf, keyed, inclusive)
    assert got == want


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("hot_rows, cut", [(499, True), (500, False), (None, True)])
def test_small_tables_are_counted_and_not_cut(spark, tmp_path, keyed, hot_rows, cut):
    pdf = sample()
    if keyed:
        pdf["k"] = "hot"
    frame(spark, pdf).write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    out = running(stored, "seq", states(), ["k"] if keyed else [], True, (16, 4), hot_rows)
    assert ("_block2" in out._jdf.queryExecution().toString()) == cut
    got = {r["seq"]: (r["n"], r["total"], r["top"], r["low"], r["prev"]) for r in out.collect()}
    assert got == expected(pdf, keyed, True)


def test_running_keeps_every_row_and_column(spark):
    out = running(frame(spark, sample()), "seq", {"n": count_state()}, ["k"], widths=(5,), hot_rows=50)
    assert out.columns == ["seq", "k", "v", "n"] and out.count() == 500


def test_empty_and_single_row(spark):
    empty = frame(spark, sample().head(0))
    assert running(empty, "seq", states()).collect() == []
    one = spark.createDataFrame([(9, "a", 2.0)], "seq long, k string, v double")
    row = running(one, "seq", states(), inclusive=False).first()
    assert (row["n"], row["total"], row["top"], row["prev"]) == (0, 0, None, None)


def test_no_single_partition_window_on_rows(spark):
    plan = running(frame(spark, sample()), "seq", {"n": count_state()})._jdf.queryExecution()
    text = plan.executedPlan().toString()
    # the rows are exchanged by block; only block totals meet in one partition
    assert "hashpartitioning(_block2" in text and "Broadcast" not in text


def test_number_by_compound_order(spark):
    pdf = sample(300).assign(g=lambda d: d["seq"] % 4)
    df = spark.createDataFrame([(int(s), int(g)) for s, g in zip(pdf.seq, pdf.g)], "seq long, g long")
    got = [(r["g"], r["seq"]) for r in number_by(df, ["g", "seq"]).orderBy("rank").collect()]
    assert got == sorted(got)
    ranks = sorted(r["rank"] for r in number_by(df, ["g", "seq"]).collect())
    assert ranks == list(range(300))


def test_ranks_and_rounds(spark):
    df = with_rank(frame(spark, sample()), "seq")
    got = [r["rank"] for r in df.orderBy("seq").collect()]
    assert got == list(range(500))
    rounds = {r["rank"]: r["b"] for r in df.select("rank", doubling_block("rank", 16).alias("b")).collect()}
    for rank, b in rounds.items():
        lo, hi = doubling_bounds(b, 16)
        assert lo <= rank < hi
    full = full_count_windows(df, "rank", 120)
    assert {r["block"]: r["n"] for r in full.collect()} == {b: 120 for b in range(4)}

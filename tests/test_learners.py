import numpy as np
import pytest
from compare import bayes_by_join
from pyspark.sql import functions as F

from millrace.learners import bayes, ensemble
from millrace.learners.baseline import majority_class, no_change
from millrace.learners.linear import MAP_BYTES, MAX_FAN_OUT, _of_many_blocks, fan_out, linear_scan
from millrace.learners.network import (
    Autoencoder,
    EncodedNetwork,
    Network,
    OneHot,
    class_targets,
    perceptron,
    train_in_rounds,
)
from millrace.learners.tree import TreeParams, hoeffding_rounds, prequential_hoeffding
from millrace.operators.order import doubling_bounds, fixed_block, with_rank
from millrace.runtime import materialise


def regression(n, width, outputs, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    y = x @ rng.normal(size=(width, outputs)) * 0.3 + 0.1
    return x, y


def regression_df(spark, x, y, keys=None):
    rows = [
        (i, None if keys is None else keys[i], x[i].tolist(), y[i].tolist()) for i in range(len(x))
    ]
    return spark.createDataFrame(
        rows, "seq long, k string, x array<double>, y array<double>"
    ).repartition(5)


def delta_rule(x, y, lr, init=0.1):
    w = np.full((x.shape[1] + 1, y.shape[1]), init)
    out = []
    for xi, yi in zip(x, y):
        xi = np.append(xi, 1.0)
        p = xi @ w
        out.append(p)
        w = w + lr * np.outer(xi, yi - p)
    return np.array(out)


@pytest.mark.parametrize("block_rows, fan", [(30, 3), (17, 100), (1000, 2)])
def test_linear_equals_the_loop(spark, block_rows, fan):
    x, y = regression(400, 5, 2)
    df = regression_df(spark, x, y)
    out = linear_scan(
        df, "seq", "x", "y", 5, 2, 0.03, block_rows=block_rows, blocks_per_super=fan
    ).orderBy("seq")
    got = np.array([r["pred"] for r in out.collect()])
    assert np.abs(got - delta_rule(x, y, 0.03)).max() < 1e-9


def test_linear_survives_gaps(spark):
    x, y = regression(200, 3, 1)
    stay = [i for i in range(200) if i != 37 and not 60 <= i < 100]
    df = regression_df(spark, x, y).filter("seq <> 37 and not (seq >= 60 and seq < 100)")
    out = linear_scan(df, "seq", "x", "y", 3, 1, 0.05, block_rows=20, blocks_per_super=2).orderBy("seq")
    got = np.array([r["pred"] for r in out.collect()])
    assert np.abs(got - delta_rule(x[stay], y[stay], 0.05)).max() < 1e-9


def test_keyed_linear_equals_one_loop_per_key(spark):
    x, y = regression(300, 3, 1)
    keys = [None if i % 7 == 0 else "hot" if i % 3 else "b" for i in range(300)]
    df = with_rank(regression_df(spark, x, y, keys), "seq", ["k"])
    out = linear_scan(
        df, "rank", "x", "y", 3, 1, 0.05, ["k"], ["seq"], block_rows=20, blocks_per_super=2
    )
    got = {r["seq"]: r["pred"][0] for r in out.collect()}
    assert len(got) == 300
    for k in set(keys):
        at = [i for i in range(300) if keys[i] == k]
        want = delta_rule(x[at], y[at], 0.05)[:, 0]
        assert np.abs(np.array([got[i] for i in at]) - want).max() < 1e-9


@pytest.mark.parametrize("fan", [2, 3])
def test_linear_of_many_levels(spark, fan):
    """Blocks of 7 rows under a tree of fan-out 2 or 3: five levels or more."""
    x, y = regression(900, 2, 1)
    df = regression_df(spark, x, y)
    out = linear_scan(df, "seq", "x", "y", 2, 1, 0.05, block_rows=7, blocks_per_super=fan).orderBy("seq")
    got = np.array([r["pred"] for r in out.collect()])
    assert np.abs(got - delta_rule(x, y, 0.05)).max() < 1e-9


def test_linear_of_135_features(spark):
    """The fan-out follows from the width: what a task composes stays below 500 MB."""
    assert fan_out(135, 1) * 8 * 136 * 137 <= MAP_BYTES < 500e6 / 4
    assert fan_out(3, 2) == MAX_FAN_OUT and fan_out(10_000, 1) == 2
    x, y = regression(600, 135, 1)
    out = linear_scan(regression_df(spark, x, y), "seq", "x", "y", 135, 1, 0.002, block_rows=50, blocks_per_super=4).orderBy("seq")
    got = np.array([r["pred"] for r in out.collect()])
    assert np.abs(got - delta_rule(x, y, 0.002)).max() < 1e-9


def test_keys_of_one_block_need_no_maps(spark):
    x, y = regression(300, 3, 1)
    df = with_rank(regression_df(spark, x, y, [f"k{i % 40}" if i % 3 else "hot" for i in range(300)]), "seq", ["k"])
    some, top = _of_many_blocks(df.withColumn("_node", F.expr("rank div 20")), ["k"])
    assert {r["k"] for r in some.select("k").distinct().collect()} == {"hot"} and top == 4
    assert _of_many_blocks(df.withColumn("_node", F.expr("rank div 2000")), ["k"])[1] == 0


def test_linear_empty(spark):
    x, y = regression(3, 2, 1)
    df = regression_df(spark, x, y).filter("seq < 0")
    assert linear_scan(df, "seq", "x", "y", 2, 1, 0.1).count() == 0


# --- networks -----------------------------------------------------------------


def plain_sgd(net, w, x, y):
    """Back-propagation for one record at a time, written out on its own."""
    ws, at = [], 0
    w = w.copy()
    for a, b in zip(net.layers, net.layers[1:]):
        ws.append(w[at : at + (a + 1) * b].reshape(a + 1, b))
        at += (a + 1) * b
    relu = lambda v: np.maximum(v, 0)
    for xi, yi in zip(x, y):
        acts = [xi]
        for m in ws:
            acts.append(relu(acts[-1] @ m[:-1] + m[-1]))
        err = yi - acts[-1]
        if net.learn_above is not None and not (np.abs(err) > net.learn_above).any():
            continue
        d = err * (acts[-1] > 0)
        for k in reversed(range(len(ws))):
            back = ws[k][:-1] @ d
            ws[k][:-1] += net.lr * np.outer(acts[k], d)
            ws[k][-1] += net.lr * d
            if k:
                d = back * (acts[k] > 0)
    return w


@pytest.mark.parametrize("above", [None, 0.4])
def test_network_rounds_equal_the_loop(spark, above):
    x, y = regression(200, 4, 2)
    y = np.abs(y)
    net = Network((4, 6, 5, 2), lr=0.02, learn_above=above)
    out = train_in_rounds(
        regression_df(spark, x, y), "seq", "x", "y", net, first=32, slice_rows=20
    )
    got = np.array([r["pred"] for r in out.orderBy("seq").collect()])
    w = net.init()
    for r in range(4):
        lo, hi = doubling_bounds(r, 32)
        want = net.predict(net.unpack(w[None]), x[None, lo:hi])[0]
        assert np.abs(got[lo:hi] - want).max() < 1e-9
        parts, sizes = [], []
        for s in range(lo // 20, (min(hi, 200) - 1) // 20 + 1):
            a, b = max(lo, s * 20), min(hi, (s + 1) * 20, 200)
            parts.append(plain_sgd(net, w, x[a:b], y[a:b]))
            sizes.append(b - a)
        w = np.average(parts, axis=0, weights=sizes)


def test_keyed_network_equals_separate_runs(spark):
    x, y = regression(240, 3, 1)
    keys = ["hot" if i % 3 else "b" for i in range(240)]
    df = with_rank(regression_df(spark, x, y, keys), "seq", ["k"])
    net = Network((3, 1), out="linear", lr=0.05)
    both = train_in_rounds(df, "rank", "x", "y", net, ["k"], ["seq"], first=16, slice_rows=25)
    got = {r["seq"]: r["pred"][0] for r in both.collect()}
    for k in ("hot", "b"):
        alone = train_in_rounds(
            df.filter(F.col("k") == k), "rank", "x", "y", net, (), ["seq"], first=16, slice_rows=25
        )
        for r in alone.collect():
            assert got[r["seq"]] == pytest.approx(r["pred"][0], abs=1e-12)


def planted(spark, n=3000, width=6, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    label = (x[:, 0] + x[:, 1] > 0).astype(int)
    rows = [(i, x[i].tolist(), int(label[i])) for i in range(n)]
    return spark.createDataFrame(rows, "seq long, x array<double>, label int").repartition(6)


def share(rows, lo, hi):
    part = [r for r in rows if lo <= r["seq"] < hi]
    return sum(r["pred"] == r["label"] for r in part) / len(part)


def improves(out, n=3000, at_least=0.8):
    rows = out.select("seq", "label", "pred").collect()
    assert len(rows) == n
    early, late = share(rows, 0, 200), share(rows, n - 1000, n)
    majority = max(np.bincount([r["label"] for r in rows])) / n
    assert late > early and late > majority and late > at_least, (early, late)


def test_perceptron_learns(spark):
    df = planted(spark).withColumn("y", class_targets("label", 2))
    out = train_in_rounds(df, "seq", "x", "y", perceptron(6, 2, 0.5), keep=["label"], first=128)
    improves(out.withColumn("pred", F.array_position("pred", F.array_max("pred")) - 1))


def test_bayes_learns(spark):
    df = planted(spark).withColumn("b", fixed_block("seq", 100))
    improves(bayes.prequential_naive_bayes(df, "b", "x", "label", 6, (0, 1)))


@pytest.mark.parametrize("leaf", ["mc", "nb", "nba"])
def test_tree_learns(spark, leaf):
    p = TreeParams(6, 2, split_confidence=0.01, grace=100, leaf=leaf)
    out = prequential_hoeffding(planted(spark), "seq", "x", "label", p, first=128)
    improves(out, at_least=0.7 if leaf == "mc" else 0.8)


def test_autoencoder_reconstructs_better_with_time(spark):
    rng = np.random.default_rng(1)
    x = rng.random((2000, 2)) @ rng.random((2, 8))
    df = regression_df(spark, x, x)
    net = Autoencoder(Network((8, 4, 2, 4, 8), out="linear", lr=0.02), 2)
    out = train_in_rounds(df, "seq", "x", "x", net, first=64).collect()
    err = {r["seq"]: np.abs(np.array(r["actual"]) - r["pred"]).mean() for r in out}
    assert np.mean([err[i] for i in range(1500, 2000)]) < 0.6 * np.mean([err[i] for i in range(64)])


def test_encoded_network_runs_both_parts(spark):
    x, y = regression(300, 6, 2)
    model = EncodedNetwork(
        Autoencoder(Network((6, 4, 2, 4, 6), out="linear"), 2), Network((2, 3, 2), out="linear")
    )
    out = train_in_rounds(regression_df(spark, x, y), "seq", "x", "y", model, first=64)
    first = [r["pred"] for r in out.filter("round = 0").collect()]
    later = [r["pred"] for r in out.filter("round = 2").collect()]
    assert len(first) == 64 and np.isfinite(later).all()


# --- score before train ----------------------------------------------------------


def no_peeking(spark, run, n=400, change=250):
    """A changed label must not move any prediction up to and including its row."""
    base = planted(spark, n)
    flipped = base.withColumn(
        "label", F.when(F.col("seq") >= change, 1 - F.col("label")).otherwise(F.col("label"))
    )
    a = {r["seq"]: r["pred"] for r in run(base).collect()}
    b = {r["seq"]: r["pred"] for r in run(flipped).collect()}
    assert all(a[i] == b[i] for i in range(change + 1))
    assert len(a) == len(b) == n


def test_no_peeking(spark):
    no_peeking(spark, lambda d: majority_class(d, "seq", "label", (0, 1)))
    no_peeking(spark, lambda d: no_change(d, "seq", "label"))
    no_peeking(
        spark,
        lambda d: bayes.prequential_naive_bayes(
            d.withColumn("b", fixed_block("seq", 50)), "b", "x", "label", 6, (0, 1)
        ),
    )
    p = TreeParams(6, 2, split_confidence=0.1, grace=30)
    no_peeking(spark, lambda d: prequential_hoeffding(d, "seq", "x", "label", p, first=32))


def test_partitioning_does_not_change_results(spark):
    p = TreeParams(6, 2, split_confidence=0.1, grace=30, leaf="nba")
    runs = []
    for parts in (1, 9):
        df = planted(spark, 600).repartition(parts)
        out = prequential_hoeffding(df, "seq", "x", "label", p, first=64)
        runs.append(sorted((r["seq"], r["leaf"], r["pred"]) for r in out.collect()))
    assert runs[0] == runs[1]


# --- naive Bayes details -----------------------------------------------------------


def test_bayes_as_matrix_and_by_join_agree_and_match_a_loop(spark):
    df = planted(spark, 300).withColumn("b", fixed_block("seq", 40))
    models = bayes.snapshots(df, "b", "x", "label", 6, (0, 1))
    joined = bayes_by_join(df, models, "b", "x", 6)
    carried = bayes.score_blocks(df, models, "b", "x", 6)
    a = {r["seq"]: r["pred"] for r in joined.collect()}
    assert a == {r["seq"]: r["pred"] for r in carried.collect()}
    rows = sorted(df.collect(), key=lambda r: r["seq"])
    x = np.array([r["x"] for r in rows])
    y = np.array([r["label"] for r in rows])
    for i in range(300):
        upto = i // 40 * 40
        scores = []
        for c in (0, 1):
            part = x[:upto][y[:upto] == c]
            if len(part):
                m, v = part.mean(0), np.maximum(1e-6, (part**2).mean(0) - part.mean(0) ** 2)
                scores.append(
                    (np.log(len(part)) - 0.5 * (np.log(2 * np.pi * v) + (x[i] - m) ** 2 / v).sum(), -c)
                )
        assert a[i] == (-max(scores)[1] if scores else 0)


def test_bayes_gate_drops_rows_without_a_model(spark):
    df = planted(spark, 120).withColumn("b", fixed_block("seq", 50))
    models = bayes.snapshots(df, "b", "x", "label", 6, (0, 1))
    out = bayes.score_blocks(df, models, "b", "x", 6, gate=True)
    assert out.agg(F.min("seq"), F.count("*")).first() == (50, 70)


def test_snapshots_only_after_full_blocks(spark):
    snaps = bayes.snapshot_stream(planted(spark, 120), "seq", "x", "label", 6, (0, 1), 50)
    assert sorted(r["valid_from"] for r in snaps.collect()) == [50, 100]


# --- trees --------------------------------------------------------------------------


def test_nominal_multiway_split(spark):
    rng = np.random.default_rng(2)
    code = rng.integers(0, 4, 2000)
    rows = [(i, [float(code[i]), float(rng.random())], int(code[i] in (1, 3))) for i in range(2000)]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int")
    for binary in (False, True):
        p = TreeParams(2, 2, nominal=((0, 4),), split_confidence=0.01, binary_splits=binary, tie=0.2)
        out = prequential_hoeffding(df, "seq", "x", "label", p, first=256).collect()
        late = [r for r in out if r["seq"] >= 1024]
        assert sum(r["pred"] == r["label"] for r in late) / len(late) > 0.95


def test_keyed_trees_equal_separate_trees(spark):
    df = planted(spark, 1200).withColumn("k", (F.col("seq") % 3).cast("int"))
    df = with_rank(df, "seq", ["k"])
    same = df.filter("k = 0").select("rank", "x", "label")
    copies = same.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    p = TreeParams(6, 2, split_confidence=0.1, grace=30)
    both = prequential_hoeffding(copies, "rank", "x", "label", p, ["k"], first=64).collect()
    alone = prequential_hoeffding(same, "rank", "x", "label", p, first=64).collect()
    want = {r["rank"]: (r["leaf"], r["pred"]) for r in alone}
    assert len(both) == 2 * len(want)
    assert all((r["leaf"], r["pred"]) == want[r["rank"]] for r in both)


def test_one_class_and_tiny_input(spark):
    df = planted(spark, 300).withColumn("label", F.lit(1))
    p = TreeParams(6, 2)
    out = prequential_hoeffding(df, "seq", "x", "label", p, first=64)
    assert {r["pred"] for r in out.filter("round > 0").collect()} == {1}
    few = prequential_hoeffding(planted(spark, 5), "seq", "x", "label", p, first=64)
    assert [r["pred"] for r in few.collect()] == [0] * 5


def test_feature_that_is_constant_at_first_can_be_split(spark):
    rng = np.random.default_rng(4)
    x = rng.random((4000, 2))
    y = (x[:, 0] > 0.5).astype(int)
    x[:64, 0] = 0.5
    y[:64] = 0
    rows = [(i, x[i].tolist(), int(y[i])) for i in range(4000)]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int")
    p = TreeParams(2, 2, split_confidence=0.01, grace=50, tie=0.1)
    out = prequential_hoeffding(df, "seq", "x", "label", p, first=64)
    assert out.filter("seq >= 2048").agg(F.avg((F.col("pred") == F.col("label")).cast("int"))).first()[0] > 0.95


def test_leaves_that_do_not_fit_are_reported(spark):
    p = TreeParams(6, 2, split_confidence=0.1, grace=30, max_nodes=2)
    versions, _ = hoeffding_rounds(planted(spark, 1500), "seq", "x", "label", p, first=64)
    last = versions.orderBy(F.desc("round")).first()
    assert last["feature"] == [-1] and last["capped"] == [0]


def test_statistics_of_a_leaf_merge_exactly(spark):
    df = planted(spark, 600)
    p = TreeParams(6, 2, grace=10_000)  # never splits, so everything stays at the root
    _, history = hoeffding_rounds(df, "seq", "x", "label", p, first=64)
    got = history.filter("round = 4 and i = 2 and label = 1").first()
    x = [r["x"][2] for r in df.filter("seq < 512 and label = 1").collect()]
    assert got["n"] == len(x) and (got["lo"], got["hi"]) == (min(x), max(x))
    assert np.allclose([got["mean"], got["m2"]], [np.mean(x), np.var(x) * len(x)])


def test_poor_attributes_are_dropped(spark):
    p = TreeParams(6, 2, split_confidence=0.1, grace=30, remove_poor=True, tie=0.01)
    out = prequential_hoeffding(planted(spark, 2000), "seq", "x", "label", p, first=64)
    assert out.count() == 2000


# --- ensembles ------------------------------------------------------------------------


def test_subsets():
    assert len(ensemble.attribute_subsets(54, 2)) == 1431
    drawn = ensemble.attribute_subsets(54, 2, 40)
    assert len(drawn) == 40 and drawn == ensemble.attribute_subsets(54, 2, 40)


def test_subset_ensemble_learns(spark):
    p = TreeParams(4, 2, split_confidence=0.05, grace=50)
    out = ensemble.subset_ensemble(planted(spark, 3000, 4), "seq", "x", "label", p, first=128)
    improves(out, at_least=0.75)


def test_one_hot_inputs_equal_spread_rows(spark):
    """Numbers learned as one-hot inputs against rows that hold these inputs, in slices
    of 70 rows, of which a task trains one or several at a time."""
    rng = np.random.default_rng(9)
    votes = rng.integers(0, 3, (400, 5))
    rows = [(i, votes[i].tolist(), [float(v == c) for v in votes[i] for c in range(3)], int(votes[i, 0] == 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, v array<int>, x array<double>, label int").withColumn("y", class_targets("label", 2))
    net = perceptron(15, 2, 0.5)
    want = train_in_rounds(df, "seq", "x", "y", net, first=64, slice_rows=70).orderBy("seq").collect()
    got = train_in_rounds(df, "seq", "v", "y", OneHot(net, 3), first=64, slice_rows=70).orderBy("seq").collect()
    assert np.allclose([r["pred"] for r in got], [r["pred"] for r in want], rtol=0, atol=1e-12)
    assert [r["actual"] for r in got] == [r["actual"] for r in want]


def test_votes_are_not_stored_as_one_hot_numbers(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(ensemble, "materialise", lambda df, name, *more: seen.setdefault(name, materialise(df, name, *more)))
    p = TreeParams(4, 2, split_confidence=0.05, grace=50)
    ensemble.subset_ensemble(planted(spark, 300, 4), "seq", "x", "label", p, first=128).count()
    assert {len(r["features"]) for r in seen["gathered"].collect()} == {6}


def test_replicas_are_independent(spark):
    df = ensemble.with_replica(planted(spark, 90), "seq", 3)
    out = majority_class(df, "replica_rank", "label", (0, 1), ["replica"]).collect()
    for rep in range(3):
        rows = sorted((r for r in out if r["replica"] == rep), key=lambda r: r["seq"])
        counts = [0, 0]
        for r in rows:
            assert r["pred"] == (0 if counts[0] >= counts[1] else 1)
            counts[r["label"]] += 1


def test_keyed_report_text(spark):
    rows = [(i, 7, i % 2) for i in range(6)]
    df = spark.createDataFrame(rows, "seq long, k long, label int")
    out = ensemble.keyed_class_report(
        df, "seq", "label", (("win", 0), ("lose", 1)), "k", warmup=3, every=2
    )
    got = [r["info"] for r in out.orderBy("seq").collect()]
    assert got == ["KEY_7 - seen 3 win=2 lose=1", "KEY_7 - seen 5 win=3 lose=2"]

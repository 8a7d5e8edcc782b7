"""Trees against a plain version that keeps all rows, published trees, rounds of
any growth, and appended rows."""

import math
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.learners import bayes, ensemble, tree
from millrace.learners.linear import linear_scan
from millrace.learners.network import class_targets, perceptron, train_in_rounds
from millrace.learners.tree import (
    TreeParams,
    _leaf_votes,
    prequential_hoeffding,
    search_leaf,
    search_leaves,
    tree_snapshots,
    tree_text,
    tree_vote,
)
from millrace.operators.connect import with_latest
from millrace.operators.order import Rounds, doubling_block, fixed_block
from millrace.plans import learning
from millrace.runtime import materialise

SF = "/root/testdata/sf0.01"


# --- the plain version ------------------------------------------------------------------


class Node:
    def __init__(self, depth, prior, label):
        self.depth, self.prior, self.label = depth, np.array(prior, float), label
        self.x, self.y, self.dropped, self.test, self.children = [], [], set(), None, []

    def leaf(self, v):
        if not self.children:
            return self
        f, kind, cut = self.test
        if kind == "numeric":
            branch = int(v[f] > cut)
        elif kind == "one":
            branch = int(v[f] != cut)
        else:
            branch = max(min(int(v[f]), len(self.children) - 1), 0)
        return self.children[branch].leaf(v)


def entropy(counts):
    counts = np.asarray(counts, float)
    share = counts[counts > 0] / counts.sum() if counts.sum() else np.zeros(0)
    return -(share * np.log2(share)).sum()


def gain(branches):
    sizes = [sum(b) for b in branches]
    if sum(s > 0 for s in sizes) < 2:
        return 0.0
    inside = sum(s * entropy(b) for s, b in zip(sizes, branches)) / sum(sizes)
    return entropy(np.sum(branches, axis=0)) - inside


def options(node, p):
    """(gain, feature, test, branches) of each feature's best split."""
    x, y, codes = np.array(node.x), np.array(node.y), dict(p.nominal)
    out = []
    for f in range(p.width):
        if f in node.dropped:
            continue
        if f in codes:
            table = [[int(((x[:, f] == v) & (y == c)).sum()) for c in range(p.classes)] for v in range(codes[f])]
            if p.binary_splits:
                total = np.sum(table, axis=0)
                found = [(gain([t, total - t]), -v, [np.array(t), total - t]) for v, t in enumerate(np.array(table))]
                g, v, branches = max(found, key=lambda o: (o[0], o[1]))
                out.append((g, f, ("one", -v), branches))
            else:
                out.append((gain(table), f, ("many", 0.0), [np.array(t) for t in table]))
            continue
        low, high, best = x[:, f].min(), x[:, f].max(), None
        for k in range(1, p.bins):
            cut = low * (1 - k / p.bins) + high * k / p.bins
            left, right = [], []
            for c in range(p.classes):
                v = x[y == c, f]
                if not len(v) or cut < v.min():
                    part = 0.0
                elif cut >= v.max():
                    part = float(len(v))
                else:
                    z = np.clip((cut - v.mean()) / max(v.std(), 1e-300), -40, 40)
                    part = len(v) * 0.5 * (1 + math.erf(z / math.sqrt(2)))
                left.append(part)
                right.append(len(v) - part)
            g = gain([left, right])
            if best is None or g > best[0]:
                best = (g, f, ("numeric", cut), [np.array(left), np.array(right)])
        out.append(best)
    return sorted(out, key=lambda o: (-o[0], o[1]))


def learn(node, p, again, now):
    """Search a leaf; gives the fresh leaves with this round's rows in them."""
    own = np.bincount(np.array(node.y, int), minlength=p.classes)
    if again:
        node.prior = np.maximum(node.prior - own, 0)
    node.label = int((node.prior + own).argmax())
    if own.sum() < p.grace or (own > 0).sum() < 2:
        return []
    ranked = options(node, p)
    bound = math.sqrt(math.log2(max(p.classes, 2)) ** 2 * math.log(1 / p.split_confidence) / (2 * own.sum()))
    rival = ranked[1][0] if len(ranked) > 1 else 0.0
    best, f, test, branches = ranked[0]
    if not (best > 0 and (best - rival > bound or bound < p.tie)):
        if p.remove_poor:
            node.dropped |= {f for g, f, *_ in ranked if best - g > bound}
        return []
    node.test = (f, *test)
    node.children = [Node(node.depth + 1, b, int(b.argmax()) if b.any() else node.label) for b in branches]
    fresh = []
    for v, c in now:
        child = node.leaf(v)
        child.x.append(v)
        child.y.append(c)
        if child not in fresh:
            fresh.append(child)
    return [(child, [(v, c) for v, c in now if node.leaf(v) is child]) for child in fresh]


def plain_tree(x, y, p, rounds):
    root, preds, r = Node(0, [0] * p.classes, 0), [], 0
    splits = set()
    while len(preds) < len(x):
        lo, hi = rounds.bounds(r)
        part = list(zip(x[lo:hi], y[lo:hi]))
        preds += [root.leaf(v).label for v, _ in part]
        touched = {}
        for v, c in part:
            leaf = root.leaf(v)
            leaf.x.append(v)
            leaf.y.append(c)
            touched.setdefault(id(leaf), (leaf, []))[1].append((v, c))
        # a leaf without rows of this round has been searched before, but not seen them
        todo = [(leaf, rows, False) for leaf, rows in touched.values()]
        while todo:
            leaf, rows, again = todo.pop()
            fresh = learn(leaf, p, again, rows)
            if fresh:
                splits.add(r)
            todo += [(child, own, True) for child, own in fresh]
        r += 1
    return preds, splits


def rows_of(df, rank, x, label):
    got = sorted(df.select(rank, x, label).collect())
    return [list(map(float, r[1])) for r in got], [r[2] for r in got]


@pytest.mark.parametrize("growth", [1.0, 1.6, 2.0])
def test_tree_equals_the_plain_version(spark, growth):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(size=700), rng.random(700), rng.integers(0, 3, 700), np.full(700, 0.5)])
    y = ((x[:, 0] > 0) ^ (x[:, 2] == 1)).astype(int)
    rows = [(i, x[i].tolist(), int(y[i])) for i in range(700)]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int")
    rounds = Rounds(120 if growth == 1 else 60, growth)
    options = dict(binary_splits=True, remove_poor=True) if growth != 2 else {}
    p = TreeParams(4, 2, nominal=((2, 3),), grace=40, split_confidence=0.05, tie=0.2, **options)
    out = prequential_hoeffding(df, "seq", "x", "label", p, first=rounds).orderBy("seq").collect()
    want, splits = plain_tree(x.tolist(), y.tolist(), p, rounds)
    assert [r["pred"] for r in out] == want
    assert len(splits) >= 3 and np.mean([r["pred"] == r["label"] for r in out[-200:]]) > 0.9


@pytest.mark.parametrize("name", ["m6_hoeffding", "m9_hoeffding_nominal"])
def test_tree_queries_equal_the_plain_version(spark, name):
    """On the rows of the query itself; both split in three rounds or more."""
    if name == "m6_hoeffding":
        df, p, rounds = learning.planted(spark, SF), TreeParams(64, 2, **learning.QUICK), learning.GROWING
    else:
        df = learning.mixed_events(spark, "/root/testdata/sf0.001")
        p, rounds = TreeParams(3, 2, nominal=((2, 5),), **learning.TREE), Rounds(512)
    x, y = rows_of(df, "rank", "x", "label")
    want, splits = plain_tree(x, y, p, rounds)
    sf = SF if name == "m6_hoeffding" else "/root/testdata/sf0.001"
    got = contract.queries()[name](spark, sf).orderBy("rank").collect()
    assert [r["pred"] for r in got] == want
    assert len(splits) >= (3 if name == "m6_hoeffding" else 1)


def test_stacked_tree_equals_the_plain_version(spark):
    """The final tree of the stack, over the flags of the base models."""
    p = TreeParams(3, 2, nominal=((0, 2), (1, 2), (2, 2)), **learning.QUICK)
    flags = learning.voted_flags(spark, SF)
    x, y = rows_of(flags, "pos", "x", "label")
    want, splits = plain_tree(x, y, p, learning.GROWING)
    got = prequential_hoeffding(flags, "pos", "x", "label", p, first=learning.GROWING).orderBy("pos").collect()
    assert [r["pred"] for r in got] == want and splits
    assert np.mean([r["pred"] == r["label"] for r in got[200:]]) > 0.8


# --- published trees ----------------------------------------------------------------------


def small_rows(spark, n=400):
    rng = np.random.default_rng(9)
    x = rng.random((n, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(int)
    return spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(n)], "seq long, x array<double>, label int")


def test_published_trees_give_the_prequential_predictions(spark):
    df, p, rounds = small_rows(spark), TreeParams(3, 2, grace=30, split_confidence=0.1, tie=0.2), Rounds(90, 1.0)
    snaps = tree_snapshots(df, "seq", "x", "label", p, first=rounds)
    table = {r["version"]: r for r in snaps.collect()}
    assert [table[v]["valid_from"] for v in sorted(table)] == [90, 180, 270, 360]
    judged = with_latest(df, "seq", {"tree": snaps}, by_reference=True)
    plain = with_latest(df, "seq", {"tree": snaps})
    vote = F.coalesce(tree_vote("x", "tree"), F.lit(0)).alias("pred")
    want = {r["seq"]: r["pred"] for r in prequential_hoeffding(df, "seq", "x", "label", p, first=rounds).collect()}
    for frame in (judged, plain):
        assert {r["seq"]: r["pred"] for r in frame.select("seq", vote).collect()} == want
    waiting = with_latest(df, "seq", {"tree": snaps}, gate=True, by_reference=True)
    assert waiting.agg(F.min("seq"), F.count("*")).first() == (90, 310)
    for r in snaps.select("params", tree_text("params").alias("t")).collect():
        f, depth = r["params"]["feature"], r["params"]["depth"]
        tests = ",".join(f"x{v}@{d}" for v, d in zip(f, depth) if v >= 0)
        leaves = sum(v < 0 for v in f)
        assert r["t"] == f"nodes {len(f)} leaves {leaves} depth {max(depth)} splits {tests}"
    assert max(table[4]["params"]["depth"]) >= 2


def test_votes_of_models_of_different_kinds(spark):
    df, p = small_rows(spark), TreeParams(3, 2, grace=30, split_confidence=0.1, tie=0.2)
    snaps = tree_snapshots(df, "seq", "x", "label", p, first=Rounds(100, 1.0))
    nb = bayes.snapshot_stream(df, "seq", "x", "label", 3, (0, 1), 50)
    out = ensemble.latest_votes(df, "seq", "x", 3, {"nb": nb}, {"tree": snaps}, gate=False)
    got = {r["seq"]: (r["nb"], r["tree"]) for r in out.collect()}
    own = prequential_hoeffding(df, "seq", "x", "label", p, first=Rounds(100, 1.0))
    other = bayes.prequential_naive_bayes(df.withColumn("b", fixed_block("seq", 50)), "b", "x", "label", 3, (0, 1))
    trees = {r["seq"]: r["pred"] for r in own.collect()}
    votes = {r["seq"]: r["pred"] for r in other.collect()}
    assert got == {i: (votes[i], trees[i]) for i in range(400)}


# --- rounds ---------------------------------------------------------------------------------


@pytest.mark.parametrize("rounds", [Rounds(10, 1.0), Rounds(7, 1.3), Rounds(3, 1.01), Rounds(16, 2.0), Rounds(5, 10.0)])
def test_rounds(spark, rounds):
    df = spark.range(3000)
    got = df.select("id", doubling_block("id", rounds).alias("b")).withColumn("s", rounds.start(F.col("b"))).collect()
    for r in got:
        lo, hi = rounds.bounds(r["b"])
        assert lo <= r["id"] < hi and r["s"] == lo
    far = 10**10
    assert spark.range(far, far + 1).select(doubling_block("id", rounds).alias("b")).first()["b"] > 0


def test_doubling_is_the_growth_of_two(spark):
    both = spark.range(2000).select(doubling_block("id", 16).alias("a"), doubling_block("id", Rounds(16, 2.0)).alias("b"))
    assert both.where("a <> b").count() == 0


def test_appended_rows_change_nothing_before_them(spark):
    """Every learner, also where a round goes on into the appended rows."""
    whole = small_rows(spark, 400)
    p = TreeParams(3, 2, grace=30, split_confidence=0.1, tie=0.2, leaf="nba")
    rounds = Rounds(40, 1.4)
    y = class_targets("label", 2)
    runs = {
        "tree": lambda d: prequential_hoeffding(d, "seq", "x", "label", p, first=rounds),
        "perceptron": lambda d: train_in_rounds(d.withColumn("y", y), "seq", "x", "y", perceptron(3, 2, 0.5), first=rounds),
        "linear": lambda d: linear_scan(d.withColumn("y", y), "seq", "x", "y", 3, 2, 0.05, block_rows=30, blocks_per_super=3),
        "bayes": lambda d: bayes.prequential_naive_bayes(d.withColumn("b", fixed_block("seq", 50)), "b", "x", "label", 3, (0, 1)),
    }
    for name, run in runs.items():
        few = {r["seq"]: r["pred"] for r in run(whole.filter("seq < 290")).collect()}
        more = {r["seq"]: r["pred"] for r in run(whole).collect()}
        assert len(few) == 290 and len(more) == 400, name
        assert all(np.array_equal(few[i], more[i]) for i in few), name


# --- attribute subsets --------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 5])
def test_trees_of_all_pairs_equal_plain_trees(spark, parts):
    """Every pair's tree against the plain version on that pair's columns."""
    rng = np.random.default_rng(12)
    x = np.column_stack([rng.normal(size=(420, 3)), rng.integers(0, 4, 420)])
    y = ((x[:, 0] + x[:, 1] > 0) ^ (x[:, 3] == 2)).astype(int)
    rows = [(i, x[i].tolist(), int(y[i])) for i in range(420)]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int").repartition(parts)
    pairs = ensemble.attribute_subsets(4)
    p = TreeParams(4, 2, nominal=((3, 4),), grace=40, split_confidence=0.05, tie=0.2)
    out = ensemble.subset_votes(df, "seq", "x", "label", pairs, p, 64).orderBy("seq").collect()
    assert len(pairs) == 6 and [r["label"] for r in out] == y.tolist()
    for m, (a, b) in enumerate(pairs):
        own = TreeParams(2, 2, nominal=tuple((k, 4) for k, f in enumerate((a, b)) if f == 3), grace=40, split_confidence=0.05, tie=0.2)
        want, splits = plain_tree(x[:, [a, b]].tolist(), y.tolist(), own, Rounds(64))
        assert [r["votes"][m] for r in out] == want
    assert splits


def test_subsets_take_missing_values(spark):
    rows = [(i, None if i % 9 == 0 else [float(i % 7), None if i % 5 == 0 else float("nan") if i % 4 == 0 else i / 300], i % 7 > 3 if i % 11 else None) for i in range(300)]
    rows = [(i, x, None if y is None else int(y)) for i, x, y in rows]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int")
    p = TreeParams(2, 2, grace=30, split_confidence=0.1, tie=0.2)
    out = ensemble.subset_votes(df, "seq", "x", "label", [(0, 1)], p, 64).orderBy("seq").collect()
    alone = prequential_hoeffding(df, "seq", "x", "label", p, first=64).orderBy("seq").collect()
    assert [r["votes"] for r in out] == [[r["pred"]] for r in alone]


@pytest.mark.parametrize("how", [{}, {"binary_splits": True, "remove_poor": True}])
def test_leaves_searched_together_equal_each_alone(how):
    """Leaves of a feature or two, of one class, below the grace and with a tie."""
    rng = np.random.default_rng(5)
    p = TreeParams(4, 3, nominal=((2, 4),), grace=20, split_confidence=0.1, tie=0.1, **how)
    cells = []
    for leaf in range(300):
        for i in rng.choice(4, rng.integers(1, 5), replace=False):
            for c in rng.choice(3, rng.integers(1, 4), replace=False):
                for code in range(4) if i == 2 else (0,):
                    mean = float(rng.integers(0, 3))
                    cells.append((leaf, i, code, c, int(rng.integers(1, 60)), mean, 4.0, mean - 1, mean + 1))
    cells = pd.DataFrame(cells, columns=["leaf", "i", "bin", "label", "n", "mean", "m2", "lo", "hi"])
    together = search_leaves(cells["leaf"].to_numpy(), cells, p)
    alone = [search_leaf(part, p) for _, part in cells.groupby("leaf")]
    assert together == alone and [r["leaf"] for r in together] == list(range(300))
    assert sum(bool(r["s_feature"]) for r in together) > 20
    assert sum(bool(r["poor"]) for r in together) > 5 or not how


def test_many_leaves_take_little_time():
    """The last rounds of all pairs of 64 features search some 250,000 leaves."""
    leaves = np.repeat(np.arange(6000), 4)
    rng = np.random.default_rng(6)
    mean = rng.normal(size=len(leaves))
    cells = {"leaf": leaves, "i": np.tile([0, 0, 1, 1], 6000), "bin": np.zeros_like(leaves), "label": np.tile([0, 1], 12000)}
    cells |= {"n": np.full(len(leaves), 150), "mean": mean, "m2": np.full(len(leaves), 100.0), "lo": mean - 2, "hi": mean + 2}
    began = time.process_time()
    found = search_leaves(leaves, cells, TreeParams(2, 2))
    assert len(found) == 6000 and time.process_time() - began < 3


def test_only_trees_with_fresh_leaves_are_grown_again(spark, monkeypatch):
    """Within a round trees that did not split are neither counted nor written again."""
    written = []

    def noting(df, name, *more):
        out = materialise(df, name, *more)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(tree, "materialise", noting)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(512, 6))
    rows = [(i, x[i].tolist(), int(x[i, 0] > 0)) for i in range(512)]
    df = spark.createDataFrame(rows, "seq long, x array<double>, label int").repartition(1)
    p = TreeParams(6, 2, grace=40, split_confidence=0.01, tie=0.01)
    votes = ensemble.subset_votes(df, "seq", "x", "label", ensemble.attribute_subsets(6), p, 128)
    sizes = [n for name, n in written if name == "trees"]
    assert votes.count() == 512 and max(sizes) == 15
    # only the five pairs with the first feature tell the label
    assert 0 < min(sizes) <= 5


def test_rows_for_many_trees_are_dealt_by_their_number(spark):
    """Vectors are few bytes, which Spark would read in one task."""
    rows = spark.range(0, 4000, 1, 1)
    assert [tree.dealt(rows, n).rdd.getNumPartitions() for n in (0, 100, 600, 4000, 1 << 20)] == [1, 1, 3, 8, 16]
    assert tree.dealt(rows, 4000).count() == 4000


def test_leaf_votes_equal_a_loop():
    rng = np.random.default_rng(4)
    p = TreeParams(3, 3, nominal=((2, 4),))
    n = 200
    x = np.column_stack([rng.normal(size=n), rng.normal(size=n) * 3, rng.integers(-1, 6, n)]).astype(float)
    x[rng.random((n, 3)) < 0.2] = np.nan
    x[5] = np.nan
    x[6, 0] = np.inf
    cells = []
    for c in (0, 2):  # class 1 was never seen
        for i in (0, 1):
            if (c, i) != (2, 1):  # class 2 never had feature 1
                cells.append({"i": i, "bin": 0, "label": c, "n": 5 + c + i, "mean": 0.3 * c - i, "m2": 4.0 * c * (i + 1)})
        for code in range(c, 4):
            cells.append({"i": 2, "bin": code, "label": c, "n": 1 + code + c, "mean": 0.0, "m2": 0.0})
    kind = pa.list_(
        pa.struct([(f, pa.int32()) for f in ("i", "bin", "label")] + [("n", pa.int64()), ("mean", pa.float64()), ("m2", pa.float64())])
    )
    votes = _leaf_votes(pa.scalar(cells, kind), x, p).to_pylist()

    def vote(row):
        best = []
        for c in range(3):
            prior, total = 0, 0.0
            for i, v in enumerate(row):
                if not math.isfinite(v):
                    continue
                of = [e for e in cells if e["i"] == i and e["label"] == c]
                count = sum(e["n"] for e in of)
                prior = max(prior, count)
                if i == 2:
                    code = min(max(int(v), 0), 3)
                    hit = sum(e["n"] for e in of if e["bin"] == code)
                    total += math.log((hit + 1) / (count + 4))
                elif of:
                    var = max(of[0]["m2"] / of[0]["n"], 1e-6)
                    total -= 0.5 * (math.log(2 * math.pi * var) + (v - of[0]["mean"]) ** 2 / var)
            best.append((math.log(prior) + total if prior else -1e300, -c))
        return -max(best)[1]

    want = [vote(r) if np.isfinite(r).any() else None for r in x]
    assert votes == want and votes[5] is None and {0, 2} <= set(votes)

"""Hoeffding trees (Domingos & Hulten, 2000), grown in rounds.

A tree is one row of arrays, so a single tree and a million trees (one per key)
are the same table. In each round rows are routed by a column expression, and one
partial aggregate gives the statistics of ``(leaf, feature, class)``. Splits are
searched leaf by leaf and applied key by key. Rounds double in length, so the number of
Spark jobs grows with the logarithm of the rows. Every row is scored with the
tree as of the start of its round; all versions stay in one table and the scores
are a single pass at the end. Within a round the round's own rows are routed again to
the fresh leaves of a split and counted there, until no fresh leaf splits, so a tree
can grow by several levels a round. Rows are stored once, by round.

Numeric features are summed up by count, mean, squared deviations, least and
greatest value, over all rows a leaf has seen; candidate cuts are evenly spaced
between the extremes, and the rows on either side follow from normal
distributions. Nominal features have one count per code. Values that are null,
NaN or infinite are left out.

A split that does not fit ``max_nodes`` gives way to the next good one; leaves
that could not split for ``max_nodes`` or ``max_depth`` are listed in ``capped``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.carried import matrix_of, score_carried
from millrace.operators.grouped import map_sorted_groups
from millrace.operators.order import Rounds, doubling_block, rounds_of
from millrace.runtime import materialise

NUMERIC, MULTIWAY, ONE_VALUE = 0, 1, 2
#: Rows of a task at least, unless there is one task only, and at most.
DEALT_ROWS = 256, 1 << 16


@dataclass(frozen=True)
class TreeParams:
    width: int
    classes: int
    nominal: tuple[tuple[int, int], ...] = ()  # (position, number of codes)
    split_confidence: float = 1e-7
    grace: int = 200
    tie: float = 0.05
    bins: int = 10
    max_nodes: int = 255
    max_depth: int = 20
    binary_splits: bool = False
    remove_poor: bool = False
    leaf: str = "mc"  # majority class, 'nb' = naive Bayes, 'nba' = the better one

    def __post_init__(self):
        if self.leaf not in ("mc", "nb", "nba"):
            raise ValueError("leaf must be 'mc', 'nb' or 'nba'")


_TREE_DDL = (
    "feature array<int>, kind array<int>, threshold array<double>, child array<int>, "
    "arity array<int>, depth array<int>, prior array<double>, label_at array<int>, "
    "dropped array<int>, capped array<int>, fresh int"
)
_TREE_COLS = [part.split()[0] for part in _TREE_DDL.split(", ")]


def _stump(p: TreeParams) -> dict:
    return {
        "feature": [-1], "kind": [0], "threshold": [0.0], "child": [0], "arity": [0],
        "depth": [0], "prior": [0.0] * p.classes, "label_at": [0], "dropped": [],
        "capped": [], "fresh": -1,
    }


# --- splitting ----------------------------------------------------------------

_SEARCH_DDL = (
    "leaf int, own array<double>, s_feature array<int>, s_kind array<int>, s_cut array<double>, "
    "s_arity array<int>, s_branches array<double>, poor array<int>"
)
_SEARCH_COLS = [part.split()[0] for part in _SEARCH_DDL.split(", ")]
_CELL = ("leaf", "i", "bin", "label", "n", "mean", "m2", "lo", "hi")


def _erf(z: np.ndarray) -> np.ndarray:
    return np.array([math.erf(v) for v in z.ravel().tolist()], float).reshape(z.shape)


def _entropy(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1, keepdims=True)
    share = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
    logs = np.log2(share, out=np.zeros_like(share), where=share > 0)
    return -(share * logs).sum(axis=-1)


def _gains(branches: np.ndarray) -> np.ndarray:
    """Information gain of splits given as (..., branch, class) counts."""
    weights = branches.sum(axis=-1)
    total = np.maximum(weights.sum(axis=-1), 1e-300)
    inside = (weights * _entropy(branches)).sum(axis=-1) / total
    useful = (weights > 0).sum(axis=-1) >= 2
    return np.where(useful, _entropy(branches.sum(axis=-2)) - inside, 0.0)


def _numeric_splits(row: np.ndarray, cells: dict[str, np.ndarray], rows: int, p: TreeParams) -> tuple:
    """Best cuts of numeric features, one a row: ``(gains, kinds, cuts, branch counts)``."""
    shape = (rows, p.classes)
    where = (row, cells["label"])
    n, mean, dev = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    lo, hi = np.full(shape, np.inf), np.full(shape, -np.inf)
    for target, name in ((n, "n"), (mean, "mean"), (dev, "m2"), (lo, "lo"), (hi, "hi")):
        target[where] = cells[name]
    dev = np.sqrt(dev / np.maximum(n, 1))
    low, high = lo.min(axis=1, keepdims=True), hi.max(axis=1, keepdims=True)
    share = np.arange(1, p.bins) / p.bins
    cuts = low * (1 - share) + high * share  # (row, cut)
    z = (cuts[:, :, None] - mean[:, None]) / np.maximum(dev, 1e-300)[:, None]
    below = n[:, None] * 0.5 * (1 + _erf(np.clip(z, -40, 40) / math.sqrt(2)))
    below = np.where(cuts[:, :, None] < lo[:, None], 0.0, below)
    below = np.where(cuts[:, :, None] >= hi[:, None], n[:, None], below)
    branches = np.stack([below, n[:, None] - below], axis=2)
    gains = _gains(branches)
    every, best = np.arange(rows), gains.argmax(axis=1)
    return gains[every, best], NUMERIC, cuts[every, best], branches[every, best]


def _nominal_splits(tables: np.ndarray, p: TreeParams) -> tuple:
    """The same for one nominal feature from its (row, code, class) counts."""
    if not p.binary_splits:
        return _gains(tables), MULTIWAY, 0.0, tables
    branches = np.stack([tables, tables.sum(axis=1, keepdims=True) - tables], axis=2)
    gains = _gains(branches)
    every, best = np.arange(len(tables)), gains.argmax(axis=1)
    return gains[every, best], ONE_VALUE, best, branches[every, best]


def search_leaves(at: np.ndarray, cells: Mapping[str, Sequence], p: TreeParams) -> list[dict]:
    """For each of the leaves that ``at`` numbers from 0 on, in order: its class counts,
    the splits that the Hoeffding bound allows (best first) and, with ``remove_poor``,
    the features that fall behind by it."""
    nominal = dict(p.nominal)
    cell = {c: np.asarray(cells[c]) for c in _CELL}
    # a slot is one feature of one leaf
    stride = int(cell["i"].max()) + 1
    slots, slot = np.unique(at * stride + cell["i"], return_inverse=True)
    of, feature = slots // stride, slots % stride
    seen = np.bincount(slot * p.classes + cell["label"], cell["n"], len(slots) * p.classes).reshape(-1, p.classes)
    # the feature with the fewest missing values tells the rows of a leaf
    total = seen.sum(axis=1)
    fullest = np.lexsort((feature, -total, of))
    own = seen[fullest[np.flatnonzero(np.diff(of[fullest], prepend=-1))]]
    n = own.sum(axis=1)
    names = cell["leaf"][np.flatnonzero(np.diff(at, prepend=-1))]
    out = [{c: [] for c in _SEARCH_COLS} | {"leaf": leaf, "own": counts} for leaf, counts in zip(names.tolist(), own.tolist())]
    use = ((n >= p.grace) & ((own > 0).sum(axis=1) >= 2))[of]
    if not use.any():
        return out
    gain, kind, cut = np.zeros(len(slots)), np.zeros(len(slots), np.int64), np.zeros(len(slots))
    branches = np.empty(len(slots), object)

    def put(which: np.ndarray, found: tuple) -> None:
        gain[which], kind[which], cut[which] = found[:3]
        for s, counts in zip(which.tolist(), found[3]):
            branches[s] = counts

    for f in [None, *nominal]:
        own_slots = use & (~np.isin(feature, list(nominal)) if f is None else feature == f)
        which, row = np.flatnonzero(own_slots), np.cumsum(own_slots) - 1
        if not len(which):
            continue
        mine = own_slots[slot]
        part = {c: v[mine] for c, v in cell.items()}
        row = row[slot[mine]]
        if f is None:
            put(which, _numeric_splits(row, part, len(which), p))
        else:
            tables = np.zeros((len(which), nominal[f], p.classes))
            tables[row, part["bin"], part["label"]] = part["n"]
            put(which, _nominal_splits(tables, p))
    ranked = np.flatnonzero(use)
    ranked = ranked[np.lexsort((feature[ranked], -gain[ranked], of[ranked]))]
    first = np.flatnonzero(np.diff(of[ranked], prepend=-1))
    last = np.append(first[1:], len(ranked))
    leaf = of[ranked[first]]
    best = gain[ranked[first]]
    # not splitting at all is the rival when there is only one feature
    rival = np.where(last - first > 1, gain[ranked[np.minimum(first + 1, len(ranked) - 1)]], 0.0)
    span = math.log2(max(p.classes, 2))
    bound = np.sqrt(span * span * math.log(1 / p.split_confidence) / (2 * n[leaf]))
    splits = (best > 0) & ((best - rival > bound) | (bound < p.tie))
    for k in np.flatnonzero(splits).tolist():
        found = out[leaf[k]]
        for s in ranked[first[k] : last[k]].tolist():
            if s == ranked[first[k]] or gain[s] > bound[k]:
                found["s_feature"].append(int(feature[s]))
                found["s_kind"].append(int(kind[s]))
                found["s_cut"].append(float(cut[s]))
                found["s_arity"].append(len(branches[s]))
                found["s_branches"].extend(branches[s].ravel().tolist())
    for k in np.flatnonzero(~splits).tolist() if p.remove_poor else ():
        options = ranked[first[k] : last[k]]
        out[leaf[k]]["poor"] = feature[options[best[k] - gain[options] > bound[k]]].tolist()
    return out


def search_leaf(cells: pd.DataFrame, p: TreeParams) -> dict:
    """The same for one leaf."""
    return search_leaves(np.zeros(len(cells), np.int64), cells, p)[0]


def grow(tree: dict, leaves: Iterable[dict], p: TreeParams, again: bool = False) -> dict:
    """Apply the splits that were found for the leaves of one tree, in order. ``again``: the
    leaves are fresh ones, counted from rows that their priors already stand for.
    ``fresh`` is the first node made by this call, -1 if there is none."""
    t = {c: np.asarray(tree[c]).tolist() for c in _TREE_COLS if c != "fresh"}
    dropped, capped, nodes = set(t["dropped"]), set(t["capped"]) if again else set(), len(t["feature"])
    for found in leaves:
        leaf = int(found["leaf"])
        at = slice(leaf * p.classes, (leaf + 1) * p.classes)
        prior = np.array(t["prior"][at])
        if again:
            prior = np.maximum(prior - found["own"], 0.0)
            t["prior"][at] = prior.tolist()
        prior = prior + found["own"]
        t["label_at"][leaf] = int(prior.argmax())
        dropped |= {leaf * p.width + int(f) for f in found["poor"]}
        room = p.max_nodes - len(t["feature"])
        fits = [k for k, size in enumerate(found["s_arity"]) if size <= room]
        if not fits or t["depth"][leaf] >= p.max_depth:
            capped |= {leaf} if len(found["s_arity"]) else set()
            continue
        pick = fits[0]
        start = int(sum(found["s_arity"][:pick])) * p.classes
        size = int(found["s_arity"][pick])
        branches = np.reshape(found["s_branches"][start : start + size * p.classes], (size, -1))
        t["feature"][leaf] = int(found["s_feature"][pick])
        t["kind"][leaf] = int(found["s_kind"][pick])
        t["threshold"][leaf] = float(found["s_cut"][pick])
        t["child"][leaf] = len(t["feature"])
        t["arity"][leaf] = size
        for branch in branches:
            t["feature"].append(-1)
            t["kind"].append(0)
            t["threshold"].append(0.0)
            t["child"].append(0)
            t["arity"].append(0)
            t["depth"].append(t["depth"][leaf] + 1)
            t["prior"].extend(float(c) for c in branch)
            t["label_at"].append(int(branch.argmax()) if branch.any() else t["label_at"][leaf])
    t["dropped"], t["capped"] = sorted(dropped), sorted(capped)
    t["fresh"] = nodes if len(t["feature"]) > nodes else -1
    return t


# --- routing and counting ----------------------------------------------------


def route(features: str, tree: str | None = None) -> Column:
    """Leaf of a row: follow the arrays from the root, as deep as the tree is. The
    arrays are columns, or fields of the struct ``tree``."""

    def at(name: str, node: Column) -> Column:
        return F.get(F.col(f"{tree}.{name}" if tree else name), node)

    def down(node: Column, _: Column) -> Column:
        x = F.get(F.col(features), at("feature", node))
        cut = at("threshold", node)
        branch = (
            F.when(at("kind", node) == NUMERIC, (x > cut).cast("int"))
            .when(at("kind", node) == ONE_VALUE, (x != cut).cast("int"))
            .otherwise(F.greatest(F.least(x.cast("int"), at("arity", node) - 1), F.lit(0)))
        )
        return F.when(at("feature", node) < 0, node).otherwise(
            at("child", node) + F.coalesce(branch, F.lit(0))
        )

    depth = F.col(f"{tree}.depth" if tree else "depth")
    return F.aggregate(F.sequence(F.lit(0), F.array_max(depth)), F.lit(0), down)


def tree_vote(features: str, tree: str) -> Column:
    """Class of a row by the tree in a struct; null where there is no tree."""
    return F.get(F.col(f"{tree}.label_at"), route(features, tree))


def tree_text(tree: str) -> Column:
    """A tree in words: its size and depth, and the feature of every split in the
    order in which they were made."""
    features = F.col(f"{tree}.feature")
    tests = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(features) - 1), lambda i: F.get(features, i) >= 0),
        lambda i: F.concat(F.lit("x"), F.get(features, i).cast("string"), F.lit("@"), F.get(F.col(f"{tree}.depth"), i).cast("string")),
    )
    leaves = F.size(F.filter(features, lambda f: f < 0))
    return F.format_string(
        "nodes %d leaves %d depth %d splits %s",
        F.size(features), leaves, F.array_max(F.col(f"{tree}.depth")), F.array_join(tests, ","),
    )


def _bin(x: Column, i: Column, p: TreeParams) -> Column:
    """The code of a nominal feature, 0 for a numeric one."""
    if not p.nominal:
        return F.lit(0)
    codes = [0] * p.width
    for at, size in p.nominal:
        codes[at] = size
    size = F.get(F.lit(codes), i)
    return F.when(size > 0, F.greatest(F.least(x.cast("int"), size - 1), F.lit(0))).otherwise(0)


def _usable(x: Column) -> Column:
    """Neither null, NaN (which Spark orders last) nor infinite."""
    return F.abs(x) < F.lit(float("inf"))


def _merged(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Statistics of earlier rounds and of this one, at most two rows a group."""
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    apart = F.max("mean") - F.min("mean")
    between = F.when(F.count("*") > 1, apart * apart * F.min("n") * F.max("n") / n).otherwise(0.0)
    return parts.groupBy(*by).agg(
        n.alias("n"), mean.alias("mean"), (F.sum("m2") + between).alias("m2"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )


def _attach(rows: DataFrame, trees: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with the tree of its key and round. One global tree is a single
    row of at most ``max_nodes`` entries, hence the broadcast; keyed trees are
    joined as the planner sees fit."""
    return rows.join(trees if keys else F.broadcast(trees), [*keys, "round"])


def round_sizes(rows: DataFrame) -> dict[int, int]:
    """Rows of every round."""
    found = rows.filter(F.col("round").isNotNull()).groupBy("round").count().collect()
    return {r["round"]: r["count"] for r in found}


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows that many trees route, in tasks by their number: their bytes, by which
    files are split, tell little of the time."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, math.ceil(n / DEALT_ROWS[0])), math.ceil(n / DEALT_ROWS[1]))
    if tasks == 1:
        return rows.coalesce(1)
    return rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks)


def stored_even(rows: DataFrame, name: str) -> DataFrame:
    """Rows stored by round, each round in a file a core, so that ``dealt`` finds them
    apart and need not shuffle them in every pass."""
    return materialise(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism), name, ["round"])


def hoeffding_rounds(
    df: DataFrame,
    rank: str,
    features: str,
    label: str,
    params: TreeParams,
    keys: Sequence[str] = (),
    first: int | Rounds = 1024,
    counter: Callable[..., DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Grow the trees. Returns the versions table (``round`` = the round a
    version scores) and the statistics each version was left with. Both hold at
    most ``max_nodes`` leaves per key and round. ``first``: the length of the first
    round where rounds double, or any ``Rounds``. ``counter(rows, trees, again)``
    may give the statistics of the leaves instead, for trees that share their rows, or
    None where no tree is given; ``keys`` are then whole numbers that rows do not have
    (see ``subset_counter``)."""
    spark = df.sparkSession
    keys, p = list(keys), params
    rows = df.select(
        *([] if counter else keys),
        rank,
        F.col(features).alias("_x"),
        F.col(label).alias("label"),
        doubling_block(rank, first).alias("round"),
    )
    rows = stored_even(rows, "tree-rows") if counter else materialise(rows, "tree-rows", ["round"])
    sizes = round_sizes(rows)
    last = max(sizes, default=0)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    key_ddl = "".join(f"{k} {'int' if counter else fields[k]}, " for k in keys)
    stump = _stump(p)
    start = spark.createDataFrame([tuple(stump[c] for c in _TREE_COLS)], _TREE_DDL)

    def search(cells: pd.DataFrame) -> pd.DataFrame:
        head = cells[keys].iloc[:1].reset_index(drop=True)
        found = search_leaf(cells, p)
        return head.assign(**{c: [found[c]] for c in _SEARCH_COLS})[[*keys, *_SEARCH_COLS]]

    def updating(again: bool):
        def update(leaves: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            if leaves.empty:
                return trees[[*keys, *_TREE_COLS]].assign(fresh=-1)
            old = stump if trees.empty else trees.iloc[0].to_dict()
            head = leaves[keys].iloc[:1].reset_index(drop=True)
            new = grow(old, leaves.sort_values("leaf").to_dict("records"), p, again)
            return head.assign(**{c: [new[c]] for c in _TREE_COLS})[[*keys, *_TREE_COLS]]

        return update

    by = [*keys, "leaf", "i", "bin", "label"]

    def counted(routed: DataFrame) -> DataFrame:
        """Statistics of (leaf, feature, class) over rows with their leaf."""
        cells = routed.select(
            *keys, "leaf", "label", "dropped", F.posexplode("_x").alias("i", "_v")
        )
        cells = cells.filter(_usable(F.col("_v")) & F.col("label").isNotNull())
        if p.remove_poor:
            cells = cells.filter(
                ~F.coalesce(
                    F.array_contains("dropped", F.col("leaf") * p.width + F.col("i")), F.lit(False)
                )
            )
        return (
            cells.withColumn("bin", _bin(F.col("_v"), F.col("i"), p))
            .groupBy(*by)
            .agg(
                F.count("*").alias("n"),
                F.avg("_v").alias("mean"),
                (F.var_pop("_v") * F.count("*")).alias("m2"),
                F.min("_v").cast("double").alias("lo"),
                F.max("_v").cast("double").alias("hi"),
            )
        )

    def grown_together(stats: DataFrame, trees: DataFrame, again: bool) -> DataFrame:
        """The same for very many small trees: whole trees in bundles, each with its
        own row before the statistics of its leaves."""

        whole = ("leaf", "i", "bin", "label", "n")

        def work(groups: list[pd.DataFrame]) -> pd.DataFrame:
            known = [int(np.isnan(pdf["leaf"].iat[0])) for pdf in groups]
            cells = {c: np.concatenate([pdf[c].to_numpy()[k:] for pdf, k in zip(groups, known)]) for c in _CELL}
            cells |= {c: cells[c].astype(np.int64) for c in whole}
            of = np.repeat(np.arange(len(groups)), [len(pdf) - k for pdf, k in zip(groups, known)])
            leaves = [[] for _ in groups]
            if len(of):
                starts = (np.diff(of, prepend=-1) != 0) | (np.diff(cells["leaf"], prepend=-1) != 0)
                for k, found in zip(of[starts].tolist(), search_leaves(np.cumsum(starts) - 1, cells, p)):
                    leaves[k].append(found)
            out = []
            for pdf, k, found in zip(groups, known, leaves):
                old = {c: pdf[c].iat[0] for c in _TREE_COLS} if k else stump
                new = grow(old, found, p, again) if found else old | {"fresh": -1}
                out.append({**{c: pdf[c].iat[0] for c in keys}, **new})
            return pd.DataFrame(out)[[*keys, *_TREE_COLS]]

        cells = stats.select(*by, "n", "mean", "m2", "lo", "hi")
        both = cells.unionByName(trees.select(*keys, *_TREE_COLS), allowMissingColumns=True)
        return map_sorted_groups(both, keys, [F.col("leaf").isNotNull(), "leaf"], work, f"{key_ddl}{_TREE_DDL}")

    def grown(stats: DataFrame, trees: DataFrame, again: bool) -> DataFrame:
        """Search the leaves that ``stats`` tells of, and split."""
        if counter:
            return materialise(grown_together(stats, trees, again), "trees")
        found = stats.groupBy(*keys, "leaf").applyInPandas(search, f"{key_ddl}{_SEARCH_DDL}")
        both = found.groupBy(*keys).cogroup(trees.groupBy(*keys))
        return materialise(both.applyInPandas(updating(again), f"{key_ddl}{_TREE_DDL}"), "trees")

    def count_again(part: DataFrame, split: DataFrame, r: int) -> DataFrame | None:
        """Statistics of the fresh leaves, None where there are none."""
        if counter:
            return counter(part, split, True)
        if split.isEmpty():
            return None
        routed = _attach(part, split.withColumn("round", F.lit(r)), keys)
        return counted(routed.withColumn("leaf", route("_x")).filter("leaf >= fresh"))

    versions, history = None, None
    live, stats = None, None  # trees and counts at the start of the round
    for r in range(last):  # the model of the last round is not needed to score it
        part = rows.filter(F.col("round") == r)
        if counter:
            part = dealt(part, sizes.get(r, 0))
            counts = counter(part, live, False)
        elif live is None:
            counts = counted(
                part.withColumn("leaf", F.lit(0)).withColumn("dropped", F.lit(None).cast("array<int>"))
            )
        else:
            counts = counted(_attach(part, live, keys).withColumn("leaf", route("_x")))
        if stats is not None:
            # counts of leaves that have not been split go on
            kept = (
                _attach(stats, live, keys)
                .filter(F.get("feature", F.col("leaf")) < 0)
                .filter(~F.array_contains("dropped", F.col("leaf") * p.width + F.col("i")))
                .select(*counts.columns)
            )
            counts = _merged(counts.unionByName(kept), by)
        # both tables carry the number of the round they serve
        now = F.lit(r + 1)
        stats = materialise(counts, "tree-counts").withColumn("round", now)
        trees = live
        if trees is None:
            trees = spark.createDataFrame([], f"{key_ddl}{_TREE_DDL}") if keys else start
        trees = grown(stats, trees, False)
        # the round's own rows, routed again to the leaves that are new; at most
        # ``max_depth`` times
        settled = None
        while (again := count_again(part, split := trees.filter("fresh >= 0"), r)) is not None:
            again = materialise(again, "tree-counts").withColumn("round", now)
            stats = stats.unionByName(again)
            if counter:  # the trees that did not split are left as they are
                rest = trees.filter("fresh < 0")
                settled = rest if settled is None else settled.unionByName(rest)
            trees = grown(again, split if counter else trees, True)
        if settled is not None:
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            trees = materialise(settled.unionByName(trees).coalesce(parts), "trees")
        live = trees.withColumn("round", now)
        versions = live if versions is None else versions.unionByName(live)
        history = stats if history is None else history.unionByName(stats)
    if versions is None:
        versions = spark.createDataFrame([], f"{key_ddl}{_TREE_DDL}, round int")
        history = spark.createDataFrame(
            [],
            f"{key_ddl}leaf int, i int, bin int, label int, n bigint, mean double, m2 double, "
            "lo double, hi double, round int",
        )
    return versions, history


def tree_snapshots(
    df: DataFrame,
    rank: str,
    features: str,
    label: str,
    params: TreeParams,
    keys: Sequence[str] = (),
    first: int | Rounds = 1024,
) -> DataFrame:
    """Trees as published models: ``version``, ``valid_from`` (the first position
    that may be scored with it) and ``params``, the tree as one struct of arrays. With
    ``Rounds(n, 1.0)`` a model is published after every n rows."""
    versions, _ = hoeffding_rounds(df, rank, features, label, params, keys, first)
    return versions.select(
        *keys,
        F.col("round").alias("version"),
        rounds_of(first).start(F.col("round")).alias("valid_from"),
        F.struct(*_TREE_COLS).alias("params"),
    )


def score_rounds(
    df: DataFrame,
    rank: str,
    features: str,
    label: str,
    versions: DataFrame,
    params: TreeParams,
    keys: Sequence[str] = (),
    keep: Sequence[str] = (),
    first: int | Rounds = 1024,
) -> DataFrame:
    """Score every row with the version of its round: class 0 before the first."""
    rows = df.select(
        *dict.fromkeys([*keys, rank, *keep, label]),
        F.col(features).alias("_x"),
        doubling_block(rank, first).alias("round"),
    )
    if not keys:
        # one row of max_nodes entries per round, rounds grow with log(rows)
        versions = F.broadcast(versions)
    joined = rows.join(versions, [*keys, "round"], "left")
    leaf = route("_x")
    return (
        joined.withColumn("leaf", F.when(F.col("feature").isNull(), 0).otherwise(leaf))
        .withColumn("pred", F.coalesce(F.get("label_at", F.col("leaf")), F.lit(0)))
        .select(*rows.columns, "leaf", "pred")
    )


def _leaf_votes(model: pa.Scalar, x: np.ndarray, p: TreeParams) -> pa.Array:
    """Naive Bayes over the statistics of one leaf for a matrix of rows: normal
    distributions, or shares of codes. A value that a class never had tells
    nothing; a row without any usable value has no vote."""
    cells = {f: model.values.field(f).to_numpy(zero_copy_only=False) for f in _LEAF_CELL}
    sizes = dict(p.nominal)
    usable = np.isfinite(x)
    logs = np.zeros((len(x), p.classes))
    prior = np.zeros((len(x), p.classes))
    told = np.zeros(len(x), dtype=bool)
    for i in np.unique(cells["i"]):
        of = cells["i"] == i
        rows = usable[:, i]
        label, n = cells["label"][of], cells["n"][of].astype(float)
        every = np.bincount(label, n, p.classes)
        told |= rows
        prior[rows] = np.maximum(prior[rows], every)
        if i in sizes:
            hits = np.zeros((sizes[i], p.classes))
            np.add.at(hits, (cells["bin"][of], label), n)
            code = np.clip(np.trunc(x[rows, i]), 0, sizes[i] - 1).astype(int)
            logs[rows] += np.log((hits[code] + 1.0) / (every + sizes[i]))
            continue
        mean = cells["mean"][of]
        var = np.maximum(cells["m2"][of] / n, 1e-6)
        off = x[rows, i][:, None] - mean
        normal = np.zeros((len(off), p.classes))
        normal[:, label] = -0.5 * (np.log(2 * np.pi * var) + off * off / var)
        logs[rows] += normal
    with np.errstate(divide="ignore"):
        score = np.where(prior > 0, np.log(prior) + logs, -1e300)
    return pa.array(score.argmax(axis=1), mask=~told)


_LEAF_CELL = ("i", "bin", "label", "n", "mean", "m2")


def _with_bayes_votes(
    scored: DataFrame, history: DataFrame, p: TreeParams, keys: Sequence[str]
) -> DataFrame:
    """Column ``_nb``: the vote of the statistics that a row's leaf had at the
    start of its round. They are one row a leaf, bounded by features, classes and
    codes, and enter the rows of the leaf as a carry row: rows are not spread over
    their features and not joined."""
    at = [*keys, "round", "leaf"]
    models = history.groupBy(*at).agg(F.collect_list(F.struct(*_LEAF_CELL)).alias("cells"))
    vec = scored.columns.index("_x")

    def work(model: pa.Scalar, rows: pa.RecordBatch) -> pa.Array:
        return _leaf_votes(model, matrix_of(rows.column(vec), p.width), p)

    return score_carried(scored, models, at, "cells", work, "_nb", T.IntegerType())


def _better_leaf_rule(scored: DataFrame, label: str, keys) -> DataFrame:
    """Per leaf, naive Bayes from the round in which its earlier rows of that
    leaf had come out right more often than the majority class."""
    hits = scored.groupBy(*keys, "leaf", "round").agg(
        F.sum((F.col("pred") == F.col(label)).cast("bigint")).alias("_mc"),
        F.sum((F.col("_nb") == F.col(label)).cast("bigint")).alias("_by"),
    )
    earlier = (
        Window.partitionBy(*keys, "leaf")
        .orderBy("round")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return hits.select(
        *keys,
        "leaf",
        "round",
        F.coalesce(F.sum("_by").over(earlier) > F.sum("_mc").over(earlier), F.lit(False)).alias(
            "_use"
        ),
    )


def prequential_hoeffding(
    df: DataFrame,
    rank: str,
    features: str,
    label: str,
    params: TreeParams,
    keys: Sequence[str] = (),
    keep: Sequence[str] = (),
    first: int | Rounds = 1024,
) -> DataFrame:
    """Grow and score. ``leaf='nb'`` scores leaves by naive Bayes, ``'nba'`` by
    whichever rule did better at that leaf so far."""
    keys = list(keys)
    versions, history = hoeffding_rounds(df, rank, features, label, params, keys, first)
    scored = score_rounds(df, rank, features, label, versions, params, keys, keep, first)
    out = [*dict.fromkeys([*keys, rank, *keep]), label, "round", "leaf", "pred"]
    if params.leaf == "mc":
        return scored.select(*out)
    both = _with_bayes_votes(scored, history, params, keys).drop("_x")
    if params.leaf == "nb":
        return both.withColumn("pred", F.coalesce("_nb", "pred")).select(*out)
    both = materialise(both, "tree-votes")
    rule = _better_leaf_rule(both, label, keys)
    picked = both.join(rule, [*keys, "leaf", "round"])
    return picked.withColumn(
        "pred", F.when(F.col("_use"), F.coalesce("_nb", "pred")).otherwise(F.col("pred"))
    ).select(*out)

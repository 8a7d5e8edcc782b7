"""Replicas, attribute-subset ensembles and stacking."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions.features import key_text
from millrace.learners import bayes
from millrace.learners.network import OneHot, class_targets, perceptron, train_in_rounds
from millrace.learners.tree import MULTIWAY, NUMERIC, ONE_VALUE, TreeParams, dealt, hoeffding_rounds, round_sizes, stored_even, tree_text, tree_vote
from millrace.operators.carried import matrix_of
from millrace.operators.connect import gather, tag_predictions, with_latest
from millrace.operators.metrics import progress
from millrace.operators.order import Rounds, doubling_block, fixed_block
from millrace.operators.scan import State, count_state, running
from millrace.runtime import materialise, scratch_path


def with_replica(df: DataFrame, rank: str, replicas: int, name: str = "replica") -> DataFrame:
    """Deal rows to ``replicas`` independent learners in turn; the column is then
    a key like any other. The position inside a replica follows from the rank."""
    return df.withColumns(
        {
            name: F.pmod(F.col(rank), F.lit(replicas)).cast("int"),
            f"{name}_rank": F.expr(f"`{rank}` div {int(replicas)}"),
        }
    )


def keyed_class_report(
    df: DataFrame, order: str, label: str, names: Sequence[tuple[str, int]], key: str,
    warmup: int, every: int,
) -> DataFrame:
    """Text description of each key's model, the class counts before the row, at
    every ``every``-th row of the key from the ``warmup``-th on."""
    counts = {f"_c{c}": State((F.col(label) == c).cast("bigint")) for _, c in names}
    out = running(df, order, {**counts, "_before": count_state()}, [key], inclusive=False)
    seen = F.col("_before") + 1
    out = out.filter((seen >= warmup) & (seen % every == 0))
    parts = [F.format_string(f"{n}=%d", F.col(f"_c{c}")) for n, c in names]
    text = F.concat_ws(" ", F.format_string("seen %d", F.col("_before")), *parts)
    return out.select(order, key_text(F.col(key), text).alias("info"))


def keyed_tree_report(snapshots: DataFrame, key: str) -> DataFrame:
    """Text description of every published tree of every key: its size, depth and
    the features of its splits."""
    text = tree_text("params")
    return snapshots.select(key, "version", "valid_from", key_text(F.col(key), text).alias("info"))


def attribute_subsets(
    width: int, size: int = 2, max_subsets: int | None = None, seed: int = 7
) -> list[tuple[int, ...]]:
    """All attribute subsets of one size, or an even random draw of
    ``max_subsets`` of them (a parameter of the ensemble, not of the data)."""
    every = list(itertools.combinations(range(width), size))
    if max_subsets is None or max_subsets >= len(every):
        return every
    picks = np.random.default_rng(seed).choice(len(every), max_subsets, replace=False)
    return [every[i] for i in sorted(picks)]


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    if values.dtype.kind != "i" or not len(values):
        return values
    return values.astype(np.result_type(*map(np.min_scalar_type, (values.min(), values.max()))))


class Forest:
    """Trees of subsets of one feature vector, in task memory: at most ``max_nodes``
    nodes for each subset, both parameters of the ensemble."""

    def __init__(self, subsets: Sequence[Sequence[int]], trees: DataFrame | None, only_known: bool = False):
        self.subsets = subsets
        self.place: dict[int, int] = {}
        if trees is not None:
            names = ("feature", "kind", "threshold", "child", "arity", "label_at", "dropped")
            table = trees.select("model_idx", "fresh", *names).toArrow()
            lists = {c: table[c].combine_chunks() for c in names}
            self.place = {m: k for k, m in enumerate(table["model_idx"].to_pylist())}
            self.fresh = table["fresh"].to_numpy()
            # one array a column for all trees, which a task gets sooner than many
            self.values = {c: _narrow(v.flatten().to_numpy()) for c, v in lists.items()}
            self.ends = {c: np.cumsum([0, *v.value_lengths().to_pylist()]) for c, v in lists.items()}
        self.members = sorted(self.place) if only_known else range(len(subsets))

    def tree(self, m: int) -> dict | None:
        k = self.place.get(m)
        if k is None:
            return None
        return {c: v[self.ends[c][k] : self.ends[c][k + 1]] for c, v in self.values.items()} | {"fresh": self.fresh[k]}

    def by_leaf(self, m: int, x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``rows`` of the matrix ``x`` (feature, row) in the order of their leaves in
        tree ``m``, by the rule of ``tree.route``, and their leaves. Rows of a leaf
        stay in the order given."""
        at = {0: rows}
        tree = self.tree(m)
        inner = np.flatnonzero(tree["feature"] >= 0) if tree is not None else np.zeros(0, int)
        tests = (tree[c][inner].tolist() for c in ("feature", "kind", "threshold", "child", "arity")) if len(inner) else ()
        for node, f, kind, cut, child, arity in zip(inner.tolist(), *tests):  # children come after their parents
            own = at.pop(node, None)
            if own is None:
                continue
            v = x[f].take(own)
            if kind == NUMERIC:
                branch = v > cut
            elif kind == ONE_VALUE:
                branch = (v != cut) & ~np.isnan(v)
            else:
                branch = np.where(np.isnan(v), 0.0, v).clip(0, arity - 1).astype(np.int64)
            for b in range(arity):
                part = own[branch == b] if kind == MULTIWAY else own[branch if b else ~branch]
                if len(part):
                    at[child + b] = part
        leaves = sorted(at)
        parts = [at[leaf] for leaf in leaves]
        return np.concatenate(parts), np.repeat(leaves, [len(part) for part in parts])

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Classes (subset, row) of the rows of ``x`` (feature, row)."""
        out = np.zeros((len(self.subsets), x.shape[1]), np.int32)
        rows = np.arange(x.shape[1])
        for m in self.place:
            order, leaf = self.by_leaf(m, x, rows)
            out[m, order] = self.tree(m)["label_at"][leaf]
        return out


def _features(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as a matrix (feature, row). Missing and infinite values, and missing
    vectors, are NaN."""
    out = np.ascontiguousarray(matrix_of(vectors, width).T)
    out[~np.isfinite(out)] = np.nan
    return out


CELL_DDL = "leaf int, i int, bin int, label int, n bigint, mean double, m2 double, lo double, hi double"
#: Cells of a batch, and votes of a batch, that leave a task.
CELLS, VOTES = 1 << 16, 1 << 21


def subset_counter(subsets: Sequence[Sequence[int]], params: TreeParams, members: str = "model_idx"):
    """Statistics of (subset, leaf, feature, code, class) for ``hoeffding_rounds``,
    of rows that are read once and never copied: every Arrow batch is routed through all
    trees and summed up as matrices; what leaves a task is additive."""
    codes = dict(params.nominal)
    schema = f"{members} int, {CELL_DDL}"

    def count(part: DataFrame, trees: DataFrame | None, again: bool) -> DataFrame | None:
        forest = Forest(subsets, trees, again)
        if not forest.members:
            return None

        def packed(found: list[np.ndarray]) -> pa.RecordBatch:
            columns = np.concatenate(found, axis=1)
            arrays = [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds.types)]
            return pa.RecordBatch.from_arrays(arrays, schema=kinds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                label = batch.column(1).to_numpy(zero_copy_only=False)
                rows = np.flatnonzero(~np.isnan(label.astype(float)))
                if not len(rows):
                    continue
                # in the order of their labels, also within a leaf
                rows = rows[np.argsort(label[rows], kind="stable")]
                x, found, size = _features(batch.column(0), params.width), [], 0
                for m in forest.members:
                    order, leaf = forest.by_leaf(m, x, rows)
                    tree = forest.tree(m)
                    if again:
                        old = np.searchsorted(leaf, tree["fresh"])
                        order, leaf = order[old:], leaf[old:]
                    own = label[order].astype(np.int64)
                    for f in subsets[m]:
                        v = x[f][order]
                        use = ~np.isnan(v)
                        if tree is not None and params.remove_poor and len(tree["dropped"]):
                            use &= ~np.isin(leaf * params.width + f, tree["dropped"])
                        if use.any():
                            code = v[use].clip(0, codes[f] - 1).astype(np.int64) if f in codes else 0
                            found.append(_cells(m, f, leaf[use], code, own[use], v[use], params.classes, codes.get(f, 1)))
                            size += found[-1].shape[1]
                    if size >= CELLS:
                        yield packed(found)
                        found, size = [], 0
                if found:
                    yield packed(found)

        kinds = to_arrow_schema(T._parse_datatype_string(schema))
        cells = part.select("_x", "label").mapInArrow(run, schema)
        n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
        spread = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - n * mean * mean
        return cells.groupBy(members, "leaf", "i", "bin", "label").agg(
            n.alias("n"), mean.alias("mean"), (F.sum("m2") + F.greatest(spread, F.lit(0.0))).alias("m2"),
            F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        )

    return count


def _cells(m, f, leaf, code, label, v, classes: int, codes: int) -> np.ndarray:
    """Columns (subset, leaf, feature, code, class, n, mean, m2, lo, hi) of rows in the
    order of leaf and class."""
    group = (leaf * codes + code) * classes + label
    if codes > 1:
        order = np.argsort(group, kind="stable")
        group, v = group[order], v[order]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    n = np.diff(first, append=len(group))
    mean = np.add.reduceat(v, first) / n
    off = v - np.repeat(mean, n)
    which = group[first]
    own = np.empty((10, len(first)))
    own[0], own[1], own[2] = m, which // (classes * codes), f
    own[3], own[4], own[5], own[6] = which // classes % codes, which % classes, n, mean
    own[7] = np.add.reduceat(off * off, first)
    own[8], own[9] = np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)
    return own


def subset_votes(
    df: DataFrame,
    rank: str,
    features: str,
    label: str,
    subsets: Sequence[Sequence[int]],
    params: TreeParams,
    first: int | Rounds = 1024,
) -> DataFrame:
    """One Hoeffding tree per attribute subset; ``rank``, ``label`` and ``votes``, the
    class by each tree as of the start of the row's round. Rows are read once a pass,
    whatever the number of subsets."""
    stored = df.select(rank, label, F.col(features).alias("_x"), doubling_block(rank, first).alias("round"))
    stored = stored_even(stored, "subset-rows")
    versions, _ = hoeffding_rounds(
        stored, rank, "_x", label, params, ["model_idx"], first, subset_counter(subsets, params)
    )
    sizes = round_sizes(stored)
    last = max(sizes, default=0)
    kind = stored.schema[label].dataType.simpleString()
    place = stored.schema[rank].dataType.simpleString()
    schema = f"`{rank}` {place}, `{label}` {kind}, votes array<int>"
    path = scratch_path(df.sparkSession, "subset-votes")
    for r in range(last + 1):
        forest = Forest(subsets, versions.filter(F.col("round") == r) if r else None)

        def score(batches: Iterator[pa.RecordBatch], forest: Forest = forest) -> Iterator[pa.RecordBatch]:
            step = max(1, VOTES // max(1, len(subsets)))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    own = batch.slice(start, step)
                    votes = forest.votes(_features(own.column(2), params.width))
                    ends = np.arange(votes.shape[1] + 1, dtype=np.int32) * len(subsets)
                    lists = pa.ListArray.from_arrays(ends, np.ascontiguousarray(votes.T).ravel())
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), lists], names=[rank, label, "votes"])

        # round by round, so that the driver has to send the trees of one round at a time
        part = dealt(stored.filter(F.col("round") == r).select(rank, label, "_x"), sizes.get(r, 0))
        part.mapInArrow(score, schema).write.parquet(f"{path}/round={r}")
    return df.sparkSession.read.schema(schema).parquet(path).select(rank, label, "votes")


def combine_with_perceptron(
    joined: DataFrame,
    rank: str,
    features: str,
    label: str,
    width: int,
    classes: int,
    lr: float = 1.0,
    first: int | Rounds = 1024,
    codes: int | None = None,
) -> DataFrame:
    """Final learner over the gathered predictions, one perceptron per class. With
    ``codes`` the features are whole numbers below it and are learned as one-hot inputs.
    The gathered rows are written once; each round then reads its own range."""
    stored = materialise(joined, "gathered")
    model = perceptron(width * (codes or 1), classes, lr)
    out = train_in_rounds(
        stored.withColumn("_targets", class_targets(label, classes)),
        rank,
        features,
        "_targets",
        OneHot(model, codes) if codes else model,
        keep=[label],
        first=first,
    )
    best = F.array_position("pred", F.array_max("pred")) - 1
    return out.select(rank, label, "round", best.cast("int").alias("pred"))


def subset_ensemble(
    df: DataFrame,
    rank: str,
    features: str,
    label: str,
    params: TreeParams,
    size: int = 2,
    max_subsets: int | None = None,
    first: int | Rounds = 1024,
) -> DataFrame:
    """Trees on attribute subsets, combined by per-class perceptrons over their
    one-hot votes."""
    subsets = attribute_subsets(params.width, size, max_subsets)
    votes = subset_votes(df, rank, features, label, subsets, params, first)
    stacked = votes.select(rank, F.col("votes").alias("features"), label)
    return combine_with_perceptron(
        stacked, rank, "features", label, len(subsets), params.classes, 1.0, first, params.classes
    )


def majority_snapshots(
    df: DataFrame, rank: str, label: str, classes: Sequence[int], every: int
) -> DataFrame:
    """A majority-class model after every ``every`` rows: its class counts."""
    totals = {f"c{c}": (F.col(label) == c).cast("bigint") for c in classes}
    out = progress(df, rank, every, totals)
    return out.select(
        (F.col("block") + 1).alias("version"),
        F.col("seen").alias("valid_from"),
        F.array(*totals).alias("params"),
    )


def latest_votes(
    df: DataFrame,
    rank: str,
    features: str,
    width: int,
    bayes_models: Mapping[str, DataFrame],
    trees: Mapping[str, DataFrame],
    gate: bool = True,
) -> DataFrame:
    """One column per model with its class for the row, by the newest snapshot of
    each; models of different kinds share one as-of pass. With ``gate`` rows wait
    for the first snapshots of all models, else a missing model votes for class 0."""
    snaps = {n: bayes.packed(s) for n, s in bayes_models.items()} | dict(trees)
    joined = with_latest(df, rank, snaps, gate=gate, by_reference=True)
    votes = {n: bayes.predicted(F.col(n), F.col(features), width) for n in bayes_models}
    votes |= {n: F.coalesce(tree_vote(features, n), F.lit(0)) for n in trees}
    return joined.withColumns(votes)


def stack_joined(
    frames: Sequence[DataFrame],
    rank: str,
    label: str,
    classes: int,
    lr: float = 1.0,
    first: int | Rounds = 1024,
) -> DataFrame:
    """Fresh predictions of several learners, gathered per record, with a
    perceptron over the predicted class values on top."""
    tagged = tag_predictions(
        [f.select(rank, F.col(label).alias("actual"), "pred") for f in frames],
        [rank, "actual", "pred"],
    )
    rows = gather(tagged, len(frames), [rank]).select(
        rank, "features", F.col("actual").cast("int").alias(label)
    )
    return combine_with_perceptron(rows, rank, "features", label, len(frames), classes, lr, first)


def bayes_class_votes(
    df: DataFrame, rank: str, features: str, label: str, width: int, classes: Sequence[int],
    every: int, name: str = "pred", gate: bool = True,
) -> DataFrame:
    """Naive Bayes by the latest snapshot (one per ``every`` rows); with ``gate``
    rows that precede the first snapshot are left out."""
    blocked = df.withColumn("_b", fixed_block(rank, every))
    models = materialise(
        bayes.snapshots(blocked, "_b", features, label, width, classes), "bayes-models"
    )
    return bayes.score_blocks(
        blocked, models, "_b", features, width, name=name, gate=gate
    ).drop("_b")

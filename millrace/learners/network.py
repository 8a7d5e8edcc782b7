"""Small feed-forward networks and perceptrons, trained block by block.

Non-linear learners cannot be replayed from a composed map, so they work in
rounds whose length doubles (``doubling_block``): a row is scored with the model
as of the start of its round. Within a round every slice of ``slice_rows`` rows
runs per-record back-propagation from the round's start weights, and the
row-weighted mean of the slices' weights starts the next round (parallel SGD by
model averaging, Zinkevich et al. 2010). A task runs its slices side by side. One slice per round is the plain
per-record learner with a delayed snapshot.

Scores and new weights leave a round in one pass and are written to the shared
folder, so a lost executor only repeats its slices. With ``keys`` there is one
model per key; a hot key is many slices like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.grouped import map_sorted_groups
from millrace.operators.order import Rounds, doubling_block
from millrace.runtime import materialise, scratch_path

SLICE_ROWS = 2048
LOCKSTEP = 64  # slices trained side by side in one task,
LOCKSTEP_VALUES = 1 << 24  # unless their inputs are more numbers than this

_ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "sigmoid": (lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))), lambda a: a * (1.0 - a)),
    "linear": (lambda z: z, lambda a: np.ones_like(a)),
}


@dataclass(frozen=True)
class Network:
    """Layer sizes and activations; weights live in one flat vector."""

    layers: tuple[int, ...]
    hidden: str = "relu"
    out: str = "relu"
    lr: float = 0.01
    batch: int = 1
    seed: int = 7
    learn_above: float | None = None  # train only if some |error| is larger

    @property
    def width(self) -> int:
        return self.layers[0]

    def size(self) -> int:
        return sum((a + 1) * b for a, b in zip(self.layers, self.layers[1:]))

    def init(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        parts = []
        for a, b in zip(self.layers, self.layers[1:]):
            w = rng.uniform(-1, 1, (a + 1, b)) * np.sqrt(6.0 / (a + b))
            w[-1] = 0.05  # keeps rectified units alive at the start
            parts.append(w.ravel())
        return np.concatenate(parts)

    def unpack(self, flats: np.ndarray) -> list[np.ndarray]:
        """Views into ``flats`` (one row per model), one array per layer."""
        out, at = [], 0
        for a, b in zip(self.layers, self.layers[1:]):
            out.append(flats[:, at : at + (a + 1) * b].reshape(len(flats), a + 1, b))
            at += (a + 1) * b
        return out

    def activations(self, ws: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
        acts = [x]
        for k, w in enumerate(ws):
            name = self.out if k == len(ws) - 1 else self.hidden
            acts.append(_ACTIVATIONS[name][0](acts[-1] @ w[:, :-1] + w[:, -1:]))
        return acts

    def predict(self, ws: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        return self.activations(ws, x)[-1]

    def step(self, ws: list[np.ndarray], x: np.ndarray, y: np.ndarray, live: np.ndarray) -> None:
        """One back-propagation step, in place. Axes: model, row, value; rows
        that are not ``live`` are padding."""
        acts = self.activations(ws, x)
        err = (y - acts[-1]) * live
        if self.learn_above is not None:
            err = err * (np.abs(err) > self.learn_above).any(axis=2, keepdims=True)
        delta = err * _ACTIVATIONS[self.out][1](acts[-1])
        for k in range(len(ws) - 1, -1, -1):
            back = delta @ ws[k][:, :-1].transpose(0, 2, 1) if k else None
            ws[k][:, :-1] += self.lr * (acts[k].transpose(0, 2, 1) @ delta)
            ws[k][:, -1] += self.lr * delta.sum(axis=1)
            if k:
                delta = back * _ACTIVATIONS[self.hidden][1](acts[k])


@dataclass(frozen=True)
class Autoencoder:
    """A network trained on its own input."""

    net: Network
    code_layer: int

    @property
    def batch(self) -> int:
        return self.net.batch

    @property
    def width(self) -> int:
        return self.net.width

    def init(self) -> np.ndarray:
        return self.net.init()

    def unpack(self, flats):
        return self.net.unpack(flats)

    def predict(self, ws, x):
        return self.net.predict(ws, x)

    def encode(self, ws, x):
        return self.net.activations(ws, x)[self.code_layer]

    def step(self, ws, x, y, live):
        self.net.step(ws, x, x, live)


@dataclass(frozen=True)
class EncodedNetwork:
    """An autoencoder whose code feeds a second network; a record is scored by
    the pair, then both learn from it."""

    encoder: Autoencoder
    net: Network

    @property
    def batch(self) -> int:
        return self.net.batch

    @property
    def width(self) -> int:
        return self.encoder.width

    def init(self) -> np.ndarray:
        return np.concatenate([self.encoder.init(), self.net.init()])

    def unpack(self, flats):
        cut = self.encoder.net.size()
        return self.encoder.unpack(flats[:, :cut]), self.net.unpack(flats[:, cut:])

    def predict(self, ws, x):
        return self.net.predict(ws[1], self.encoder.encode(ws[0], x))

    def step(self, ws, x, y, live):
        code = self.encoder.encode(ws[0], x)
        self.encoder.step(ws[0], x, y, live)
        self.net.step(ws[1], code, y, live)


@dataclass(frozen=True)
class OneHot:
    """A network whose inputs are whole numbers below ``codes``, each learned as
    ``codes`` inputs. Rows travel as the numbers; a step at a time is spread out."""

    net: Network
    codes: int

    @property
    def batch(self) -> int:
        return self.net.batch

    @property
    def width(self) -> int:
        return self.net.width // self.codes

    @property
    def takes(self) -> str:
        return "array<tinyint>" if self.codes <= 128 else "array<int>"

    def init(self) -> np.ndarray:
        return self.net.init()

    def unpack(self, flats):
        return self.net.unpack(flats)

    def spread(self, x: np.ndarray) -> np.ndarray:
        return (x[..., None] == np.arange(self.codes)).reshape(*x.shape[:-1], -1).astype(float)

    def predict(self, ws, x):
        some = max(1, LOCKSTEP_VALUES // (8 * len(x) * self.net.width))
        parts = [self.net.predict(ws, self.spread(x[:, at : at + some])) for at in range(0, x.shape[1], some)]
        return np.concatenate(parts, axis=1)

    def step(self, ws, x, y, live):
        self.net.step(ws, self.spread(x), y, live)


def train_lockstep(model, flats: np.ndarray, xs: list[np.ndarray], ys: list[np.ndarray]):
    """Train one model per slice, all slices one step at a time: the same
    arithmetic per slice, with array operations shared between slices. Returns
    the predictions by the start weights and the trained weights."""
    rows = max(len(x) for x in xs)
    x = np.zeros((len(xs), rows, xs[0].shape[1]))
    y = np.zeros((len(xs), rows, ys[0].shape[1]))
    live = np.zeros((len(xs), rows, 1))
    for i, (xi, yi) in enumerate(zip(xs, ys)):
        x[i, : len(xi)], y[i, : len(yi)], live[i, : len(xi)] = xi, yi, 1.0
    preds = model.predict(model.unpack(flats), x)
    trained = flats.copy()
    ws = model.unpack(trained)
    for at in range(0, rows, model.batch):
        part = slice(at, at + model.batch)
        model.step(ws, x[:, part], y[:, part], live[:, part])
    return [p[: len(xi)] for p, xi in zip(preds, xs)], trained


def perceptron(width: int, classes: int, lr: float = 1.0, batch: int = 1) -> Network:
    """One sigmoid output per class, no hidden layer."""
    return Network((width, classes), out="sigmoid", lr=lr, batch=batch)


def _matrix(col: pd.Series) -> np.ndarray:
    return np.array(col.tolist(), dtype=np.float64)


def train_in_rounds(
    df: DataFrame,
    rank: str,
    features: str,
    targets: str,
    model,
    keys: Sequence[str] = (),
    keep: Sequence[str] = (),
    first: int | Rounds = 1024,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Columns ``keys``, ``rank``, ``keep``, ``actual``, ``pred`` (arrays) and
    ``round``. ``rank`` is the gapless position, per key when there are keys.

    Rows are stored once, by round, so that many rounds do not mean many scans."""
    spark = df.sparkSession
    keys = list(keys)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    passed = list(dict.fromkeys([*keys, rank, *keep]))
    rows = df.select(
        *passed,
        F.col(features).cast(getattr(model, "takes", "array<double>")).alias("_x"),
        F.col(targets).cast("array<double>").alias("actual"),
        F.expr(f"`{rank}` div {int(slice_rows)}").alias("_slice"),
        doubling_block(rank, first).alias("_round"),
    )
    rows = materialise(rows, "network-rows", ["_round"])
    last = rows.agg(F.max("_round")).first()[0]
    out_path = scratch_path(spark, "network-rounds")
    out_ddl = ", ".join(f"{c} {fields[c]}" for c in passed) + (
        ", actual array<double>, pred array<double>, _w array<double>, _n bigint"
    )
    out_cols = [*passed, "actual", "pred", "_w", "_n"]

    def worker(start: np.ndarray):
        def work(groups: list[pd.DataFrame]) -> pd.DataFrame:
            starts, slices = [], []
            for pdf in groups:
                w = pdf["_w"].iloc[0]
                if w is not None:  # the key's own start weights sort first
                    pdf = pdf.iloc[1:]
                if len(pdf):
                    starts.append(start if w is None else np.asarray(w))
                    slices.append(pdf)
            if not slices:
                return groups[0].iloc[:0].assign(
                    pred=pd.Series(dtype=object), _n=pd.Series(dtype="int64")
                )[out_cols]
            preds, trained = train_lockstep(
                model,
                np.array(starts),
                [_matrix(pdf["_x"]) for pdf in slices],
                [_matrix(pdf["actual"]) for pdf in slices],
            )
            # a slice's new weights ride on its first row
            out = pd.concat(slices, ignore_index=True)
            sizes = [len(pdf) for pdf in slices]
            new = np.full(len(out), None, dtype=object)
            for at, w in zip(np.cumsum([0, *sizes[:-1]]), trained):
                new[at] = w
            return out.assign(
                pred=[row for p in preds for row in p], _w=new, _n=np.repeat(sizes, sizes)
            )[out_cols]

        return work

    by = [*keys, "_slice"]
    lockstep = max(1, min(LOCKSTEP, LOCKSTEP_VALUES // (slice_rows * model.width)))
    origin = model.init()
    weights = None
    for r in range(0 if last is None else last + 1):
        part = rows.filter(F.col("_round") == r).drop("_round")
        part = part.withColumn("_w", F.lit(None).cast("array<double>"))
        start = origin
        if keys and r:
            # one carry row per slice holds the key's weights; fresh column
            # identities keep the two sides of the join apart
            slices = part.select(*[F.col(c).alias(c) for c in by]).distinct()
            part = part.unionByName(slices.join(weights, keys), allowMissingColumns=True)
        elif r:
            start = weights
        done = map_sorted_groups(
            part, by, [F.col("_w").isNull(), rank], worker(start), out_ddl, lockstep
        )
        round_path = f"{out_path}/round={r}"
        done.write.parquet(round_path)
        mean = (
            spark.read.parquet(round_path)
            .filter(F.col("_w").isNotNull())
            .groupBy(*keys)
            .agg(
                vector_to_array(
                    Summarizer.mean(array_to_vector("_w"), F.col("_n").cast("double"))
                ).alias("_w")
            )
        )
        weights = mean if keys else np.array(mean.first()["_w"])
    if last is None:
        empty = spark.createDataFrame([], out_ddl).withColumn("round", F.lit(0))
        return empty.drop("_w", "_n")
    return spark.read.parquet(out_path).drop("_w", "_n")


def class_targets(label: str, classes: int):
    """One target per class: 1.0 for the label's own, else 0.0."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: (c == F.col(label)).cast("double")
    )

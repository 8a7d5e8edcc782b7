"""Queries of linear learners and networks against a loop that takes one record at
a time, on the query's own rows read without Spark."""

import math

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract
from millrace.plans import learning
from millrace.plans.preparation import EVENT_CODES

SF = "/root/testdata/sf0.001"
SLICE = 2048
RELU = (lambda z: np.maximum(z, 0), lambda a: (a > 0) * 1.0)
SIGMOID = (lambda z: 1 / (1 + np.exp(-z)), lambda a: a * (1 - a))
LINEAR = (lambda z: z, lambda a: np.ones_like(a))


class Plain:
    """One feed-forward network, one record at a time."""

    def __init__(self, layers, lr, weights, hidden=RELU, out=RELU, above=None):
        self.shapes = [(a + 1, b) for a, b in zip(layers, layers[1:])]
        self.lr, self.above = lr, above
        self.kinds = [hidden] * (len(layers) - 2) + [out]
        self.load(weights)

    def load(self, flat):
        cuts = np.cumsum([a * b for a, b in self.shapes])
        self.ws = [p.reshape(s).copy() for p, s in zip(np.split(flat, cuts[:-1]), self.shapes)]

    def dump(self):
        return np.concatenate([w.ravel() for w in self.ws])

    def layers_of(self, x):
        acts = [x]
        for w, (f, _) in zip(self.ws, self.kinds):
            acts.append(f(np.append(acts[-1], 1.0) @ w))
        return acts

    def learn(self, x, y):
        acts = self.layers_of(x)
        miss = y - acts[-1]
        if self.above is not None and np.abs(miss).max() <= self.above:
            return
        new, delta = [], miss * self.kinds[-1][1](acts[-1])
        for k in range(len(self.ws) - 1, -1, -1):
            new.insert(0, self.ws[k] + self.lr * np.outer(np.append(acts[k], 1.0), delta))
            if k:
                delta = (self.ws[k][:-1] @ delta) * self.kinds[k - 1][1](acts[k])
        self.ws = new


class Alone:
    """A network by itself, or one that learns its own input."""

    def __init__(self, plain, own_input=False):
        self.plain, self.own_input = plain, own_input
        self.load, self.dump = plain.load, plain.dump

    def predict(self, x):
        return self.plain.layers_of(x)[-1]

    def learn(self, x, y):
        self.plain.learn(x, x if self.own_input else y)


class Coded:
    """A network over the code of an autoencoder; both learn from a record."""

    def __init__(self, coder, net, at):
        self.coder, self.net, self.at = coder, net, at

    def load(self, flat):
        cut = sum(a * b for a, b in self.coder.shapes)
        self.coder.load(flat[:cut])
        self.net.load(flat[cut:])

    def dump(self):
        return np.concatenate([self.coder.dump(), self.net.dump()])

    def predict(self, x):
        return self.net.layers_of(self.coder.layers_of(x)[self.at])[-1]

    def learn(self, x, y):
        code = self.coder.layers_of(x)[self.at]
        self.coder.learn(x, x)
        self.net.learn(code, y)


def by_rounds(model, x, y, first, growth=2.0):
    """Round and score of every row, by the model as of the start of its round."""
    rounds, preds, lo, hi, turn = [], [], 0, first, 0
    while lo < len(x):
        end = min(hi, len(x))
        start = model.dump()
        preds += [model.predict(row) for row in x[lo:end]]
        rounds += [turn] * (end - lo)
        parts, sizes = [], []
        for s in range(lo // SLICE, (end - 1) // SLICE + 1):
            rows = range(max(lo, s * SLICE), min(end, (s + 1) * SLICE))
            model.load(start)
            for i in rows:
                model.learn(x[i], y[i])
            parts.append(model.dump())
            sizes.append(len(rows))
        model.load(np.average(parts, axis=0, weights=sizes))
        lo, hi, turn = hi, math.ceil(hi * growth), turn + 1
    return np.array(rounds), np.array(preds)


def line_rows():
    t = pd.read_parquet(f"{SF}/lineitem.parquet")
    t = t.sort_values(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    q, d, tax, price = (t[c].to_numpy() for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice"))
    x = np.stack([q / 50, d * 10, tax * 10], axis=1)
    return x, np.stack([0.3 * q / 50 + 2 * d - tax + 0.2, price / 100000], axis=1)


def planted_rows():
    t = pd.read_parquet(f"{SF}/embeddings.parquet").sort_values("vec_id")
    x = np.stack(t["embedding"].to_list())
    return x.astype(float), (x[:, 0] + x[:, 1] > 0).astype(int)


def result(spark, name, by=("rank",)):
    return contract.queries()[name](spark, SF).toPandas().sort_values(list(by)).reset_index(drop=True)


def columns(got, stem):
    return got[[c for c in got.columns if c.startswith(stem)]].to_numpy()


def one_hot(label):
    return np.eye(2)[label]


def test_linear_query(spark):
    x, y = line_rows()
    w, preds = np.full((4, 2), 0.1), []
    for xi, yi in zip(np.c_[x, np.ones(len(x))], y):
        preds.append(xi @ w)
        w += 0.05 * np.outer(xi, yi - preds[-1])
    got = result(spark, "m4_linear_scan")
    assert got["rank"].tolist() == list(range(len(x)))
    assert np.abs(columns(got, "actual") - y).max() < 1e-8
    assert np.abs(columns(got, "pred") - preds).max() < 1e-8


@pytest.mark.parametrize(
    "name, layers, above",
    [("m12_mlp", (3, 8, 8, 4, 2), None), ("m13_mlp_conditional", (3, 8, 4, 2), 0.1)],
)
def test_network_queries(spark, name, layers, above):
    x, y = line_rows()
    start = learning.Network(layers, lr=0.01).init()
    rounds, preds = by_rounds(Alone(Plain(layers, 0.01, start, above=above)), x, y, 1024)
    got = result(spark, name)
    assert len(set(rounds)) >= 3 and got["round"].tolist() == rounds.tolist()
    assert np.abs(columns(got, "actual") - y).max() < 1e-6
    assert np.abs(columns(got, "pred") - preds).max() < 2e-6
    # the scores change from round to round, so something was learned
    assert np.abs(preds[rounds == 0].mean(axis=0) - preds[rounds == 2].mean(axis=0)).max() > 1e-3


def same_classes(got, preds):
    clear = np.abs(preds[:, 0] - preds[:, 1]) > 1e-9
    assert clear.mean() > 0.9
    assert (got["pred"].to_numpy() == preds.argmax(axis=1))[clear].all()


def test_perceptron_query(spark):
    x, label = planted_rows()
    start = learning.perceptron(64, 2).init()
    model = Alone(Plain((64, 2), 0.5, start, out=SIGMOID))
    rounds, preds = by_rounds(model, x, one_hot(label), 64, 1.5)
    got = result(spark, "m5_perceptron")
    assert got["round"].tolist() == rounds.tolist() and got["label"].tolist() == label.tolist()
    same_classes(got, preds)


def test_keyed_perceptron_query(spark):
    t = pd.read_parquet(f"{SF}/events.parquet").sort_values("event_id")
    t["code"] = t["event_type"].map(dict(EVENT_CODES))
    start = learning.perceptron(2, 2).init()
    got = result(spark, "m10_keyed_perceptron", ["user_id", "event_id"]).groupby("user_id")
    assert sum(len(g) for _, g in got) == len(t)
    for user, rows in t.groupby("user_id"):
        x = rows[["value", "code"]].to_numpy() / [500, 5]
        label = (rows["value"] > 250).astype(int).to_numpy()
        model = Alone(Plain((2, 2), 1.0, start, out=SIGMOID))
        rounds, preds = by_rounds(model, x, one_hot(label), 16)
        mine = got.get_group(user)
        assert mine["event_id"].tolist() == rows["event_id"].tolist()
        assert mine["round"].tolist() == rounds.tolist() and mine["label"].tolist() == label.tolist()
        same_classes(mine, preds)


def coder(start):
    return Plain(learning.CODER.layers, 0.01, start, out=LINEAR)


def test_autoencoder_query(spark):
    x, _ = planted_rows()
    rounds, preds = by_rounds(Alone(coder(learning.CODER.init()), True), x, x, 64)
    got = result(spark, "m14_autoencoder")
    assert got["round"].tolist() == rounds.tolist()
    assert np.abs(got["mae"].to_numpy() - np.abs(x - preds).mean(axis=1)).max() < 2e-6


def test_network_over_codes_query(spark):
    x, label = planted_rows()
    layers = (4, 4, 4, 2)
    net = Plain(layers, 0.01, learning.Network(layers, lr=0.01).init())
    rounds, preds = by_rounds(Coded(coder(learning.CODER.init()), net, 3), x, one_hot(label), 64)
    got = result(spark, "m15_autoencoder_mlp")
    assert got["round"].tolist() == rounds.tolist()
    assert np.abs(columns(got, "actual") - one_hot(label)).max() < 1e-9
    assert np.abs(columns(got, "pred") - preds).max() < 2e-6

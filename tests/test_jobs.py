"""Whole jobs on small files of the documented layouts."""

import numpy as np
import pytest

from millrace.plans import jobs, presets


def write(tmp_path, rows):
    path = tmp_path / "data.csv"
    path.write_text("".join(",".join(str(v) for v in r) + "\n" for r in rows))
    return str(path)


@pytest.fixture(scope="module")
def rng():
    return np.random.default_rng(8)


def games(rng, n=260):
    f = rng.integers(-1, 2, (n, 116))
    f[:, 2] = rng.integers(0, 3, n)
    return [[1 if r[5] > 0 else -1, *r] for r in f]


def test_tree_job(spark, tmp_path, rng):
    scored, report = jobs.tree_job(
        spark, write(tmp_path, games(rng)), presets.game_outcome(), 2, every=50, first=32,
        grace=30, split_confidence=0.1, tie=0.2, max_depth=5,
    )
    assert scored.count() == 260
    assert [r["seen"] for r in report.orderBy("seen").collect()] == [50, 100, 150, 200, 250]


def test_keyed_tree_job(spark, tmp_path, rng):
    out = jobs.keyed_tree_job(
        spark, write(tmp_path, games(rng)), presets.game_outcome(), 2, key_slot=2, warmup=20,
        first=16, grace=20, max_depth=5,
    )
    rows = out.collect()
    assert rows and min(r["seen"] for r in rows) == 20 and len({r["key"] for r in rows}) == 3


def test_train_test_job(spark, tmp_path, rng):
    out = jobs.train_test_job(spark, write(tmp_path, games(rng)), presets.game_outcome(), 2, 100)
    assert sorted(r["block"] for r in out.collect()) == [0, 1]


def methane(rng, n=120):
    rows = []
    for i in range(n):
        sensors = rng.random(28).round(3)
        sensors[26] = i % 3  # the coded column
        rows.append([2014, 3, 2, 0, i // 60, i % 60, *sensors, *(rng.random(3) * 2).round(2)])
    return rows


def test_linear_and_network_jobs(spark, tmp_path, rng):
    path = write(tmp_path, methane(rng))
    scored, report = jobs.linear_job(spark, path, presets.methane_linear(), 0.0002, every=50)
    assert scored.count() == 120 and report.count() == 2 * 3
    for encode in (False, True):
        scored, levels = jobs.network_job(spark, path, encode, first=32)
        assert levels.groupBy().sum("n").first()[0] == 360 and levels.count() == 9


def test_window_network_job(spark, tmp_path, rng):
    scored, short = jobs.window_network_job(spark, write(tmp_path, methane(rng)), first=32)
    # 120 seconds, windows of 15: the edges have too few rows
    assert scored.count() == 106 and short.count() == 28

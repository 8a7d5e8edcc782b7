"""Approximate nearest neighbours by shifted Hilbert curves.

A random rotation is cut into projections of ``DIMS`` dimensions; each, with a
random shift, orders all vectors along a Hilbert curve. Every curve is cut by
quantiles of its keys into ranges of equal count. A query is scored, exactly
and in double precision, against its own range and the ``reach`` next ones on
either side; the best of all curves are merged.

Ranges are salted so that a task holds about ``TASK_VECTORS`` vectors, and
queries of a range are salted in the same way, so tasks stay bounded at any
size and for a vector that repeats very often.

With fixed shares of a curve the work grows with queries times vectors: vectors
without structure, for which no order brings neighbours together, need it for a
recall of 0.9. Where there is structure, more ``ranges`` cost less.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do null ids. Repeated ids count once,
with the first of their vectors in the order of arrays, and are no candidates of themselves. Ties go to the smaller id. With fewer
candidates than asked for, all come back; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import materialise

CURVES = 16
DIMS = 4
BITS = 10
RANGES = 48
REACH = 1
TASK_VECTORS = 4096
TASK_QUERIES = 2048
#: A range has at least so many vectors.
LEAST_RANGE = 64
SEED = 17


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of integer cells (n, dims) on the Hilbert curve of that order.

    From the highest bit down, each dimension is exchanged with the first or
    inverts it, as the orientation of the sub-cube asks; the Gray code of what
    results is undone and the bits are interleaved."""
    x = np.ascontiguousarray(cells.T).astype("u8")
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(len(x)):
            inverts = (x[i] & bit) != 0
            swap = np.where(inverts, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverts, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], "u8")
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(b)) & one != 0, (one << np.uint64(b)) - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], "u8")
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << one) | ((row >> np.uint64(b)) & one)
    return key.astype("i8")


def projections(width: int, curves: int, dims: int, seed: int = SEED) -> tuple[list[np.ndarray], np.ndarray]:
    """Orthogonal projections from as few rotations as possible, and shifts."""
    random, out = np.random.default_rng(seed), []
    dims = min(dims, width)
    while len(out) < curves:
        rotation = np.linalg.qr(random.normal(size=(width, width)))[0]
        out += [rotation[:, a : a + dims] for a in range(0, width - dims + 1, dims)]
    return out[:curves], random.uniform(0, 0.5, size=(curves, dims))


def curve_keys(vectors: np.ndarray, planes, shifts, bits: int = BITS) -> np.ndarray:
    """(curves, n) keys of the directions of vectors."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    spread = 1 / np.sqrt(vectors.shape[1])
    out = []
    for plane, shift in zip(planes, shifts):
        place = (unit @ plane / spread + 4 + shift) / 9
        out.append(hilbert_keys(np.clip(place * (1 << bits), 0, (1 << bits) - 1).astype("i8"), bits))
    return np.stack(out)


def usable(vectors: DataFrame) -> DataFrame:
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    good = vectors.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & good & some)
    return good.groupBy("id").agg(F.min("vector").alias("vector"))


def stacked(column: pd.Series) -> np.ndarray:
    """Vectors, each scaled by a power of two so that squares neither overflow
    nor vanish: no digit and no cosine changes by that."""
    rows = np.array(column.to_list(), "f8")
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def best(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest of ``vectors`` for each query, ties to the smaller id."""
    norms, out = np.sqrt((vectors * vectors).sum(axis=1)), []
    step = max(1, 2_000_000 // max(1, len(ids)))
    for at in range(0, len(queries), step):
        q, own = queries[at : at + step], query_ids[at : at + step]
        score = (q @ vectors.T) / np.sqrt((q * q).sum(axis=1))[:, None] / norms
        score[own[:, None] == ids] = -np.inf
        last = min(k, len(ids)) - 1
        least = -np.partition(-score, last, axis=1)[:, last]
        row, col = np.nonzero((score >= least[:, None]) & (score > -np.inf))
        order = np.lexsort((ids[col], -score[row, col], row))
        row, col = row[order], col[order]
        first = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
        place = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        row, col = row[place < k], col[place < k]
        out.append(pd.DataFrame({"query_id": own[row], "id": ids[col], "score": score[row, col]}))
    return pd.concat(out)


def nearest(vectors: DataFrame, is_query, k: int = 5, curves: int = CURVES, ranges: int = RANGES, reach: int = REACH) -> DataFrame:
    """``vectors``: id long, vector array. ``is_query``: a condition on them.
    Returns query_id, rank (from 1), id, score (cosine)."""
    vectors = materialise(usable(vectors.select("id", "vector")), "vectors")
    widths = vectors.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").first()
    result = "query_id long, rank int, id long, score double"
    if widths is None:
        return vectors.sparkSession.createDataFrame([], result)
    width, n = widths["w"], widths["count"]
    vectors = vectors.where(F.size("vector") == width)
    planes, shifts = projections(width, curves, DIMS)
    ranges = max(1, min(ranges, n // LEAST_RANGE))
    salts = -(-n // (ranges * TASK_VECTORS))
    marked = vectors.withColumn("q", F.coalesce(is_query, F.lit(False)))
    asked = marked.where("q").count()
    query_salts = max(1, asked * (2 * reach + 1) // (ranges * TASK_QUERIES))

    def keys(batches):
        for batch in batches:
            if not len(batch):
                continue
            table = curve_keys(stacked(batch["vector"]), planes, shifts)
            yield pd.DataFrame({"curve": np.repeat(np.arange(curves), len(batch)), "key": table.ravel()})

    cuts = np.zeros((curves, ranges - 1), "i8")
    if ranges > 1:
        at = [i / ranges for i in range(1, ranges)]
        found = vectors.mapInPandas(keys, "curve int, key long").groupBy("curve").agg(F.percentile_approx("key", at, 20_000))
        for row in found.collect():  # curves x ranges numbers
            cuts[row[0]] = row[1]

    def placed(batches):
        """Each vector once per curve; each query also for the ranges beside."""
        for batch in batches:
            if not len(batch):
                continue
            table = curve_keys(stacked(batch["vector"]), planes, shifts)
            ids = batch["id"].to_numpy()
            for curve in range(curves):
                own = np.searchsorted(cuts[curve], table[curve], side="right")
                frame = pd.DataFrame({"curve": curve, "range": own, "id": ids, "vector": batch["vector"], "q": False})
                yield frame
                asks = batch["q"].to_numpy()
                for d in range(-reach, reach + 1):
                    there = own + d
                    ok = asks & (there >= 0) & (there < ranges)
                    if ok.any():
                        yield frame[ok].assign(range=there[ok], q=True)

    kind = vectors.schema["vector"].dataType.simpleString()
    rows = marked.mapInPandas(placed, f"id long, vector {kind}, curve int, range int, q boolean")
    luck = F.xxhash64("id", "curve")
    mine, theirs = F.pmod(luck, F.lit(salts)).cast("int"), F.pmod(luck, F.lit(query_salts)).cast("int")
    group = ["curve", "range", "salt", "query_salt"]
    base = rows.where("not q").withColumns({"salt": mine, "query_salt": F.explode(F.sequence(F.lit(0), F.lit(query_salts - 1)))})
    asks = rows.where("q").withColumns({"query_salt": theirs, "salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))})

    def score(base: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(base) or not len(asks):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "i8", "id": "i8"})
        return best(base["id"].to_numpy(), stacked(base["vector"]), asks["id"].to_numpy(), stacked(asks["vector"]), k)

    met = base.groupBy(*group).cogroup(asks.groupBy(*group)).applyInPandas(score, "query_id long, id long, score double")
    # one vector is scored on many curves; the sums may differ in the last bit
    met = met.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")

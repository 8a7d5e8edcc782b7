"""Learners, ensembles and streams over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import features as fx
from millrace.learners import bayes, ensemble
from millrace.learners.baseline import majority_class, no_change
from millrace.learners.linear import linear_scan
from millrace.learners.network import (
    Autoencoder,
    EncodedNetwork,
    Network,
    class_targets,
    perceptron,
    train_in_rounds,
)
from millrace.learners.tree import TreeParams, prequential_hoeffding, route, tree_snapshots, tree_vote
from millrace.operators import connect, metrics
from millrace.operators.order import Rounds, fixed_block, number_by, with_rank
from millrace.plans.evaluation import (
    ARGMAX_SQL,
    CODED_SQL,
    HOUR,
    KEYED_MAJORITY_SQL,
    MAJORITY_SQL,
    SECOND_SQL,
    coded_events,
    counts_sql,
    majority_scored,
    snapshots_of,
)
from millrace.plans.preparation import EVENT_CODES
from millrace.plans.registry import query, table
from millrace.runtime import materialise, scratch_path
from millrace.streaming import operators as st
from millrace.streaming.run import drain, drain_batches, end_of_input, replay

WIDTH, CLASSES = 64, 10

# --- naive Bayes, majority, last label ----------------------------------------------


def nb_models_sql(block: str, rel: str) -> str:
    return (
        f"WITH x AS (SELECT vec_id, {block} AS b, label, i, CAST(embedding[i] AS DOUBLE) AS v "
        "FROM embeddings, range(1, 65) r(i)), "
        "c AS (SELECT b, label, i, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM x GROUP BY b, label, i), "
        "g AS (SELECT d.b, l.label, f.i FROM (SELECT DISTINCT b FROM c) d, range(0, 10) l(label), range(1, 65) f(i)), "
        "p AS (SELECT g.b, g.label, g.i, sum(c.n) AS n, sum(c.s) AS s, sum(c.q) AS q FROM g JOIN c "
        f"ON c.label = g.label AND c.i = g.i AND c.b {rel} g.b GROUP BY g.b, g.label, g.i), "
        "m AS (SELECT b, label, i, n, s / n AS mean, greatest(1e-6, q / n - (s / n) * (s / n)) AS var FROM p)"
    )


def nb_scored_sql(block: str) -> str:
    return (
        nb_models_sql(block, "<")
        + ", t AS (SELECT x.vec_id, m.label, ln(max(m.n)) - 0.5 * sum(ln(2 * pi() * var) "
        "+ (x.v - mean) * (x.v - mean) / var) AS score FROM x JOIN m ON m.b = x.b AND m.i = x.i "
        "GROUP BY x.vec_id, m.label), "
        "w AS (SELECT vec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY vec_id "
        "ORDER BY score DESC, label) AS rn FROM t) WHERE rn = 1), "
        "p2 AS (SELECT e.vec_id, e.label, CAST(coalesce(w.label, 0) AS INTEGER) AS pred "
        "FROM embeddings e LEFT JOIN w USING (vec_id)) "
    )


def embeddings(spark, sf):
    return with_rank(table(spark, sf, "embeddings"), "vec_id", dense_from=0)


def bayes_scored(spark, sf, every=50):
    rows = embeddings(spark, sf).withColumn("block", fixed_block("rank", every))
    scored = bayes.prequential_naive_bayes(
        rows, "block", "embedding", "label", WIDTH, range(CLASSES)
    )
    return scored.select("vec_id", "label", "pred")


@query("m1_naive_bayes", nb_scored_sql("vec_id // 50") + "SELECT vec_id, label, pred FROM p2")
def m1(spark, sf):
    return bayes_scored(spark, sf)


@query(
    "m1_accuracy",
    nb_scored_sql("vec_id // 50") + "SELECT vec_id, pred, vec_id + 1 AS seen, CAST(sum(CASE WHEN pred = label THEN 1 ELSE 0 END) "
    "OVER (ORDER BY vec_id) AS BIGINT) AS hits, round(hits / seen, 9) AS accuracy FROM p2",
)
def m1_accuracy(spark, sf):
    # written once: the scan below reads its input twice
    scored = materialise(bayes_scored(spark, sf), "bayes-scored")
    out = metrics.prequential_accuracy(scored, "vec_id", F.col("pred") == F.col("label"))
    return out.select("vec_id", "pred", "seen", "hits", F.round("accuracy", 9).alias("accuracy"))


@query(
    "k5_nb_snapshots",
    nb_models_sql("vec_id // 100", "<=") + " SELECT b + 1 AS version, (b + 1) * 100 AS valid_from, "
    "CAST(label AS INTEGER) AS label, CAST(i - 1 AS INTEGER) AS i, CAST(n AS BIGINT) AS n, "
    "round(mean, 9) AS mean, round(var, 9) AS var FROM m "
    "WHERE (b + 1) * 100 <= (SELECT count(*) FROM embeddings)",
)
def k5(spark, sf):
    snaps = bayes.snapshot_stream(
        embeddings(spark, sf), "rank", "embedding", "label", WIDTH, range(CLASSES), 100
    )
    cells = snaps.select("version", "valid_from", F.explode("params").alias("p")).select(
        "version",
        "valid_from",
        F.col("p.label").alias("label"),
        F.col("p.n").alias("n"),
        F.posexplode(F.arrays_zip("p.mean", "p.var")).alias("i", "mv"),
    )
    return cells.select(
        "version",
        "valid_from",
        "label",
        "i",
        "n",
        F.round("mv.mean", 9).alias("mean"),
        F.round("mv.var", 9).alias("var"),
    )


@query("m2_majority", MAJORITY_SQL + "SELECT event_id, code, pred FROM p")
def m2(spark, sf):
    return majority_scored(spark, sf).select("event_id", "code", "pred")


@query(
    "m3_no_change",
    f"WITH {CODED_SQL} SELECT event_id, code, CAST(coalesce(lag(code) OVER (ORDER BY event_id), 0) AS INTEGER) "
    "AS pred FROM e",
)
def m3(spark, sf):
    return no_change(coded_events(spark, sf), "event_id", "code").select("event_id", "code", "pred")


@query(
    "m10_keyed_majority",
    KEYED_MAJORITY_SQL + "SELECT event_id, user_id, seen, pred FROM p WHERE seen >= 20",
)
def m10(spark, sf):
    scored = majority_class(
        coded_events(spark, sf), "event_id", "code", range(5), ["user_id"], seen="seen"
    )
    return scored.filter("seen >= 20").select("event_id", "user_id", "seen", "pred")


@query(
    "k7_model_info",
    KEYED_MAJORITY_SQL
    + "SELECT event_id, 'KEY_' || user_id || ' - seen ' || (seen - 1) || '"
    + "".join(f" {name}=' || c{c} || '" for name, c in EVENT_CODES)
    + "' AS info FROM p WHERE seen >= 20 AND seen % 10 = 0",
)
def k7(spark, sf):
    return ensemble.keyed_class_report(
        coded_events(spark, sf), "event_id", "code", EVENT_CODES, "user_id", warmup=20, every=10
    )


@query(
    "m11_replicas_majority",
    f"WITH {CODED_SQL}, r AS (SELECT *, event_id % 3 AS replica, "
    + counts_sql(
        "PARTITION BY event_id % 3 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    )
    + f" FROM e) SELECT event_id, CAST(replica AS INTEGER) AS replica, {ARGMAX_SQL} AS pred FROM r",
)
def m11(spark, sf):
    ranked = with_rank(coded_events(spark, sf), "event_id", dense_from=0)
    dealt = ensemble.with_replica(ranked, "rank", 3)
    scored = majority_class(dealt, "replica_rank", "code", range(5), ["replica"])
    return scored.select("event_id", "replica", "pred")


# --- linear, perceptron, networks -----------------------------------------------------


def lines(spark, sf):
    """Line items in a gapless order, as a regression stream with two targets.
    The first target follows from the features, so learning shows."""
    base = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        fx.vector([F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10]).alias("x"),
        fx.vector(
            [
                0.3 * F.col("l_quantity") / 50 + 2 * F.col("l_discount") - F.col("l_tax") + 0.2,
                F.col("l_extendedprice") / 100000,
            ]
        ).alias("y"),
    )
    # a line has no counter of its own: number it by its whole key
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return number_by(base, order).select("l_orderkey", "rank", "x", "y")


@query("m4_linear_scan")
def m4(spark, sf):
    rows = materialise(lines(spark, sf), "lines")
    out = linear_scan(rows, "rank", "x", "y", 3, 2, 0.05)
    return out.select(
        "rank",
        *[F.round(F.col("actual")[i], 9).alias(f"actual{i}") for i in range(2)],
        *[F.round(F.col("pred")[i], 9).alias(f"pred{i}") for i in range(2)],
    )


#: One step of the delta rule for each event of a user, weights as columns.
KEYED_LINEAR_SQL = (
    "WITH RECURSIVE e AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, "
    "value / 500 AS a, (event_id % 7) / 7 AS b, 0.5 * value / 500 - 0.1 AS y FROM events), "
    "s AS (SELECT user_id, CAST(0 AS BIGINT) AS r, CAST(NULL AS BIGINT) AS event_id, CAST(0.1 AS DOUBLE) AS w0, "
    "CAST(0.1 AS DOUBLE) AS w1, CAST(0.1 AS DOUBLE) AS w2, CAST(0 AS DOUBLE) AS y, CAST(0 AS DOUBLE) AS p "
    "FROM (SELECT DISTINCT user_id FROM events) UNION ALL "
    "SELECT n.user_id, n.r, n.event_id, n.w0 + 0.05 * (n.y - n.p) * n.a, n.w1 + 0.05 * (n.y - n.p) * n.b, "
    "n.w2 + 0.05 * (n.y - n.p), n.y, n.p FROM (SELECT s.user_id, e.r, e.event_id, w0, w1, w2, e.a, e.b, e.y, "
    "w0 * e.a + w1 * e.b + w2 AS p FROM s JOIN e ON e.user_id IS NOT DISTINCT FROM s.user_id AND e.r = s.r + 1) n) "
    "SELECT user_id, event_id, round(y, 9) AS actual, round(p, 9) AS pred FROM s WHERE r > 0"
)


@query("m10_keyed_linear", KEYED_LINEAR_SQL)
def m10_linear(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        fx.vector([F.col("value") / 500, F.pmod("event_id", F.lit(7)) / 7]).alias("x"),
        fx.vector([0.5 * F.col("value") / 500 - 0.1]).alias("y"),
    )
    ranked = materialise(with_rank(events, "event_id", ["user_id"]), "events-by-user")
    out = linear_scan(ranked, "rank", "x", "y", 2, 1, 0.05, keys=["user_id"], keep=["event_id"])
    return out.select(
        "user_id",
        "event_id",
        F.round(F.col("actual")[0], 9).alias("actual"),
        F.round(F.col("pred")[0], 9).alias("pred"),
    )


def planted(spark, sf):
    """Embeddings with a label that follows from the features."""
    return embeddings(spark, sf).select(
        "rank",
        "vec_id",
        F.col("embedding").alias("x"),
        (F.col("embedding")[0] + F.col("embedding")[1] > 0).cast("int").alias("label"),
    )


@query("m5_perceptron")
def m5(spark, sf):
    rows = planted(spark, sf).withColumn("y", class_targets("label", 2))
    rounds = Rounds(64, 1.5)
    out = train_in_rounds(rows, "rank", "x", "y", perceptron(WIDTH, 2, 0.5), keep=["label"], first=rounds)
    return out.select("rank", "label", "round", fx.arg_max(F.col("pred")).alias("pred"))


@query("m10_keyed_perceptron")
def m10_perceptron(spark, sf):
    events = coded_events(spark, sf).select(
        "event_id",
        "user_id",
        (F.col("value") > 250).cast("int").alias("label"),
        fx.vector([F.col("value") / 500, F.col("code") / 5]).alias("x"),
    )
    ranked = materialise(with_rank(events, "event_id", ["user_id"]), "events-by-user")
    out = train_in_rounds(
        ranked.withColumn("y", class_targets("label", 2)),
        "rank", "x", "y", perceptron(2, 2, 1.0), keys=["user_id"], keep=["event_id", "label"],
        first=16,
    )
    return out.select("user_id", "event_id", "label", "round", fx.arg_max(F.col("pred")).alias("pred"))


def network_rows(out, outputs):
    return out.select(
        "rank",
        "round",
        *[F.round(F.col("actual")[i], 6).alias(f"actual{i}") for i in range(outputs)],
        *[F.round(F.col("pred")[i], 6).alias(f"pred{i}") for i in range(outputs)],
    )


@query("m12_mlp")
def m12(spark, sf):
    rows = materialise(lines(spark, sf), "lines")
    net = Network((3, 8, 8, 4, 2), lr=0.01)
    return network_rows(train_in_rounds(rows, "rank", "x", "y", net), 2)


@query("m13_mlp_conditional")
def m13(spark, sf):
    rows = materialise(lines(spark, sf), "lines")
    net = Network((3, 8, 4, 2), lr=0.01, learn_above=0.1)
    return network_rows(train_in_rounds(rows, "rank", "x", "y", net), 2)


# layer sizes from the data's own width down to a code of four and back
CODER = Network((WIDTH, 16, 8, 4, 8, 16, WIDTH), out="linear", lr=0.01)


@query("m14_autoencoder")
def m14(spark, sf):
    rows = embeddings(spark, sf).select("rank", F.col("embedding").alias("x"))
    out = train_in_rounds(rows, "rank", "x", "x", Autoencoder(CODER, 3), first=64)
    error = F.aggregate(
        F.zip_with("actual", "pred", lambda a, p: F.abs(a - p)), F.lit(0.0), lambda acc, e: acc + e
    )
    return out.select("rank", "round", F.round(error / WIDTH, 6).alias("mae"))


@query("m15_autoencoder_mlp")
def m15(spark, sf):
    rows = planted(spark, sf).withColumn("y", class_targets("label", 2))
    model = EncodedNetwork(Autoencoder(CODER, 3), Network((4, 4, 4, 2), lr=0.01))
    return network_rows(train_in_rounds(rows, "rank", "x", "y", model, first=64), 2)


# --- trees and ensembles ---------------------------------------------------------------

TREE = dict(grace=50, split_confidence=0.01, tie=0.1)
# for the few hundred rows of embeddings: leaves of 40 rows may split
QUICK = dict(grace=40, split_confidence=0.05, tie=0.2)
GROWING = Rounds(64, 1.5)


@query("m6_hoeffding")
def m6(spark, sf):
    p = TreeParams(WIDTH, 2, **QUICK)
    return prequential_hoeffding(planted(spark, sf), "rank", "x", "label", p, first=GROWING)


@query("m8_hoeffding_mc")
def m8(spark, sf):
    """With a nominal feature of five codes, which the label depends on, and one
    that tells nothing."""
    extra = F.array(F.pmod("rank", F.lit(5)).cast("double"), F.lit(0.5))
    label = F.when(F.pmod("rank", F.lit(5)) == 2, 1 - F.col("label")).otherwise(F.col("label"))
    rows = planted(spark, sf).withColumns(
        {"x": F.concat(F.col("x").cast("array<double>"), extra), "label": label}
    )
    p = TreeParams(
        WIDTH + 2, 2, nominal=((WIDTH, 5),), binary_splits=True, remove_poor=True, leaf="mc", **QUICK
    )
    return prequential_hoeffding(rows, "rank", "x", "label", p, first=GROWING)


@query("m8_hoeffding_bayes_leaves")
def m8_bayes(spark, sf):
    p = TreeParams(WIDTH, 2, leaf="nba", **TREE)
    return prequential_hoeffding(planted(spark, sf), "rank", "x", "label", p, first=64)


def mixed_events(spark, sf):
    """Two numeric and one nominal feature; the label depends on the nominal one."""
    rows = coded_events(spark, sf).select(
        "event_id",
        "user_id",
        fx.vector([F.col("value"), F.col("user_id"), F.col("code")]).alias("x"),
        F.when(F.col("code") == 2, (F.col("value") > 250).cast("int"))
        .otherwise((F.col("code") == 0).cast("int"))
        .alias("label"),
    )
    return with_rank(rows, "event_id", dense_from=0)


@query("m9_hoeffding_nominal")
def m9(spark, sf):
    p = TreeParams(3, 2, nominal=((2, 5),), **TREE)
    return prequential_hoeffding(mixed_events(spark, sf), "rank", "x", "label", p, first=512)


@query("m10_keyed_hoeffding")
def m10_tree(spark, sf):
    rows = mixed_events(spark, sf).drop("rank").withColumn("key", F.pmod("user_id", F.lit(4)))
    ranked = materialise(with_rank(rows, "event_id", ["key"]), "events-by-key")
    p = TreeParams(3, 2, nominal=((2, 5),), **TREE)
    return prequential_hoeffding(
        ranked, "rank", "x", "label", p, keys=["key"], keep=["event_id"], first=256
    )


@query("m16_subset_ensemble")
def m16(spark, sf):
    """A tree on each of the 2,016 pairs of attributes."""
    p = TreeParams(WIDTH, 2, **TREE)
    return ensemble.subset_ensemble(planted(spark, sf), "rank", "x", "label", p, size=2, first=64)


def coded_pairs(spark, sf):
    """Two nominal features: the event code and a share of the users. The label
    follows the code, but for every seventh event."""
    y = F.col("code").isin(0, 3).cast("int")
    rows = coded_events(spark, sf).select(
        "event_id",
        fx.vector([F.col("code"), F.pmod("user_id", F.lit(4))]).alias("x"),
        F.when(F.pmod("event_id", F.lit(7)) == 0, 1 - y).otherwise(y).alias("label"),
    )
    return with_rank(rows, "event_id", dense_from=0)


SNAPSHOT_ROUNDS = Rounds(128, 1.8)
#: Class counts of each value of each feature before a round, the gain of a split on
#: it, the first round in which the bound allows the best one, and votes on both sides.
TREE_SNAPSHOTS_SQL = f"""
WITH {CODED_SQL}, e2 AS (
  SELECT event_id, code AS c, user_id % 4 AS u, CASE WHEN (event_id % 7 = 0) = (code IN (0, 3)) THEN 0 ELSE 1 END AS y,
    {' + '.join(f'CAST(event_id >= {end} AS INTEGER)' for end in SNAPSHOT_ROUNDS.ends(10**9))} AS r FROM e
), f AS (
  SELECT r, 0 AS f, c AS v, y FROM e2 UNION ALL SELECT r, 1, u, y FROM e2
), k AS (
  SELECT r, f, v, y, count(*) AS n FROM f GROUP BY ALL
), cum AS (
  SELECT w.r, f, v, y, sum(n) AS n FROM (SELECT DISTINCT r FROM e2 WHERE r > 0) w JOIN k ON k.r < w.r GROUP BY ALL
), branch AS (
  SELECT r, f, v, sum(n) AS n, -sum(n / t * log2(n / t)) AS h, arg_min(y, (-n, y)) AS vote
  FROM (SELECT *, sum(n) OVER (PARTITION BY r, f, v) AS t FROM cum) GROUP BY ALL
), root AS (
  SELECT r, sum(n) AS n, -sum(n / t * log2(n / t)) AS h, arg_min(y, (-n, y)) AS vote, count(*) AS classes
  FROM (SELECT r, y, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY r) AS t FROM cum WHERE f = 0 GROUP BY r, y) GROUP BY r
), gains AS (
  SELECT b.r, f, CASE WHEN count(*) > 1 THEN any_value(a.h) - sum(b.n * b.h) / any_value(a.n) ELSE 0 END AS g
  FROM branch b JOIN root a USING (r) GROUP BY b.r, f
), best AS (
  SELECT r, arg_min(f, (-g, f)) AS f, max(g) AS g, min(g) AS rival FROM gains GROUP BY r
), chosen AS (
  SELECT r AS s, f FROM best JOIN root USING (r)
  WHERE n >= 50 AND classes = 2 AND g > 0 AND (g - rival > sqrt(ln(100) / (2 * n)) OR sqrt(ln(100) / (2 * n)) < 0.1)
  ORDER BY r LIMIT 1
)
SELECT event_id, CAST(e2.r AS INTEGER) AS version, CAST(CASE WHEN e2.r >= s THEN 1 + CASE chosen.f WHEN 0 THEN c ELSE u END ELSE 0 END AS INTEGER) AS leaf,
  CAST(CASE WHEN e2.r >= s THEN coalesce(b.vote, past.vote) ELSE coalesce(root.vote, 0) END AS INTEGER) AS pred
FROM e2 LEFT JOIN chosen ON true LEFT JOIN root ON root.r = e2.r LEFT JOIN root past ON past.r = s
LEFT JOIN branch b ON b.r = e2.r AND b.f = chosen.f AND b.v = CASE chosen.f WHEN 0 THEN c ELSE u END
"""


@query("c1_tree_snapshots", TREE_SNAPSHOTS_SQL)
def c1_trees(spark, sf):
    """Events scored by the newest published tree of one level."""
    rows = coded_pairs(spark, sf)
    p = TreeParams(2, 2, nominal=((0, 5), (1, 4)), max_depth=1, **TREE)
    snaps = tree_snapshots(rows, "rank", "x", "label", p, first=SNAPSHOT_ROUNDS)
    versioned = snaps.select("valid_from", F.struct("version", "params").alias("params"))
    judged = connect.with_latest(rows, "rank", {"model": versioned}, by_reference=True)
    judged = judged.select("event_id", "x", "model.version", F.col("model.params").alias("tree"))
    return judged.select(
        "event_id",
        F.coalesce("version", F.lit(0)).alias("version"),
        F.coalesce(route("x", "tree"), F.lit(0)).cast("int").alias("leaf"),
        F.coalesce(tree_vote("x", "tree"), F.lit(0)).alias("pred"),
    )


@query("k7_tree_info")
def k7_trees(spark, sf):
    """What the tree of each key looks like whenever it is published."""
    rows = mixed_events(spark, sf).drop("rank").withColumn("key", F.pmod("user_id", F.lit(4)))
    ranked = materialise(with_rank(rows, "event_id", ["key"]), "events-by-key")
    p = TreeParams(3, 2, nominal=((2, 5),), **TREE)
    return ensemble.keyed_tree_report(
        tree_snapshots(ranked, "rank", "x", "label", p, ["key"], first=Rounds(64, 2.0)), "key"
    )


STACK_FLAGS_SQL = (
    "WITH s AS (SELECT vec_id + 1 AS valid_from, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) OVER (ORDER BY vec_id) AS c0, "
    "sum(y) OVER (ORDER BY vec_id) AS c1 FROM (SELECT vec_id, CASE WHEN embedding[1]::DOUBLE + embedding[2]::DOUBLE > 0 "
    "THEN 1 ELSE 0 END AS y FROM embeddings)), a AS (SELECT * FROM s WHERE valid_from % 40 = 0), "
    "b AS (SELECT * FROM s WHERE valid_from % 70 = 0) "
    "SELECT vec_id, CASE WHEN a.c0 >= a.c1 THEN 1 ELSE 0 END AS f0, CASE WHEN b.c0 >= b.c1 THEN 1 ELSE 0 END AS f1 "
    "FROM embeddings ASOF JOIN a ON vec_id >= a.valid_from ASOF JOIN b ON vec_id >= b.valid_from"
)


def stack_flags(spark, sf, kind="vote"):
    rows = planted(spark, sf)
    snaps = {
        "m0": ensemble.majority_snapshots(rows, "rank", "label", (0, 1), 40),
        "m1": ensemble.majority_snapshots(rows, "rank", "label", (0, 1), 70),
    }
    scored = connect.with_latest(rows.select("rank", "vec_id", "label"), "rank", snaps, gate=True)
    return connect.append_flags(scored, [F.col("m0"), F.col("m1")], "label", kind)


@query("m17_stack_flags", STACK_FLAGS_SQL)
def m17(spark, sf):
    flags = F.col("flags")
    return stack_flags(spark, sf).select(
        "vec_id", flags[0].cast("int").alias("f0"), flags[1].cast("int").alias("f1")
    )


def base_models(spark, sf):
    """Rows and the published models of three learners: naive Bayes, a default
    Hoeffding tree, and one with binary splits, poor attributes dropped and
    majority leaves."""
    rows = materialise(planted(spark, sf), "planted")
    nb = bayes.snapshot_stream(rows, "rank", "x", "label", WIDTH, (0, 1), 50)
    pruned = TreeParams(WIDTH, 2, binary_splits=True, remove_poor=True, leaf="mc", **QUICK)
    trees = {
        "tree": tree_snapshots(rows, "rank", "x", "label", TreeParams(WIDTH, 2, **QUICK), first=GROWING),
        "pruned": tree_snapshots(rows, "rank", "x", "label", pruned, first=Rounds(100, 1.5)),
    }
    return rows, {"nb": materialise(nb, "bayes-snapshots")}, trees


VOTES = ("nb", "tree", "pruned")


def voted_flags(spark, sf):
    """Per row, from when all three models are there, whether each votes for class 0."""
    rows, nb, trees = base_models(spark, sf)
    voted = ensemble.latest_votes(rows, "rank", "x", WIDTH, nb, trees)
    flags = F.array(*[F.col(n) == 0 for n in VOTES])
    out = voted.select("rank", "label", fx.flags_to_features(flags).alias("x"))
    return materialise(with_rank(materialise(out, "flags"), "rank", name="pos"), "stack-flags")


@query("m17_stack_tree")
def m17_tree(spark, sf):
    """Flags of the three base models, 'vote' form, into a Hoeffding tree."""
    p = TreeParams(3, 2, nominal=((0, 2), (1, 2), (2, 2)), **QUICK)
    return prequential_hoeffding(
        voted_flags(spark, sf), "pos", "x", "label", p, keep=["rank"], first=GROWING
    )


@query("m18_stack_votes")
def m18(spark, sf):
    """The latest snapshots of three base models vote; rows before the first
    snapshots wait; a perceptron learns from the flags."""
    return ensemble.combine_with_perceptron(voted_flags(spark, sf), "pos", "x", "label", 3, 2, 0.5, 64)


@query("m19_stack_joined")
def m19(spark, sf):
    """Fresh predictions of the three base models as streams of their own, gathered
    per record, into a perceptron; a model that is not there yet says class 0."""
    rows, nb, trees = base_models(spark, sf)
    each = []
    for name in VOTES:
        own = {name: nb[name]} if name in nb else {}
        tree = {name: trees[name]} if name in trees else {}
        voted = ensemble.latest_votes(rows, "rank", "x", WIDTH, own, tree, gate=False)
        each.append(voted.select("rank", "label", F.col(name).alias("pred")))
    return ensemble.stack_joined(each, "rank", "label", 2, 0.5, 64)


# --- streams -----------------------------------------------------------------------------


def halves(spark, df, order, consume, closing=None):
    """The table arrives in two pieces, cut at half of its counter."""
    last = df.agg(F.max(order)).first()[0] or 0
    replay(spark, df, order, [last // 2], consume, closing)


def windows_sql(size: int, what: str) -> str:
    return f"SELECT CAST({SECOND_SQL} // {size} * {size} AS BIGINT) AS window_start, {what} FROM events GROUP BY 1"


def _window_stream(spark, sf, delay):
    out = scratch_path(spark, "windows")
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    aggs = [F.count("*").alias("n"), F.sum("value").alias("total")]

    def consume(stream, checkpoint):
        drain(st.windowed(stream, "ts", "1 hour", aggs, delay=f"{delay} seconds"), out, checkpoint)

    halves(spark, events, "event_id", consume, end_of_input(events, "ts", HOUR + delay))
    return spark.read.parquet(out).select(
        F.unix_seconds("window.start").alias("window_start"), "n", F.round("total", 2).alias("total")
    )


@query("w6_ordered_stream", windows_sql(HOUR, "count(*) AS n, round(sum(value), 2) AS total"))
def w6(spark, sf):
    return _window_stream(spark, sf, 0)


@query("w7_watermark_stream", windows_sql(HOUR, "count(*) AS n, round(sum(value), 2) AS total"))
def w7(spark, sf):
    return _window_stream(spark, sf, 30000)


@query(
    "a1_accuracy_stream",
    "SELECT event_id, CAST(event_id + 1 AS BIGINT) AS seen, CAST(sum(CASE WHEN value > 250 THEN 1 ELSE 0 END) "
    "OVER (ORDER BY event_id) AS BIGINT) AS hits FROM events",
)
def a1_stream(spark, sf):
    out, state = scratch_path(spark, "accuracy"), scratch_path(spark, "accuracy-state")
    handle = st.running_sums(
        spark,
        out,
        state,
        "event_id",
        {"seen": F.lit(1), "hits": (F.col("value") > 250).cast("int")},
        kind="bigint",
    )
    halves(
        spark,
        table(spark, sf, "events").select("event_id", "value"),
        "event_id",
        lambda stream, checkpoint: drain_batches(stream, handle, checkpoint),
    )
    return spark.read.parquet(out).select(
        "event_id", F.col("seen").cast("bigint").alias("seen"), F.col("hits").cast("bigint").alias("hits")
    )


@query("m2_majority_stream", MAJORITY_SQL + "SELECT event_id, code, pred FROM p")
def m2_stream(spark, sf):
    out, state = scratch_path(spark, "majority"), scratch_path(spark, "majority-state")
    handle = st.majority_stream(spark, out, state, "event_id", "code", range(5))
    halves(
        spark,
        coded_events(spark, sf).select("event_id", "code"),
        "event_id",
        lambda stream, checkpoint: drain_batches(stream, handle, checkpoint),
    )
    return spark.read.parquet(out).select("event_id", "code", "pred")


@query(
    "m10_keyed_majority_stream",
    KEYED_MAJORITY_SQL + "SELECT event_id, user_id, seen, pred, round(sum(CASE WHEN pred = code THEN 1 ELSE 0 END) "
    "OVER (PARTITION BY user_id ORDER BY event_id) / (seen - 19), 9) AS accuracy FROM p WHERE seen >= 20",
)
def m10_stream(spark, sf):
    out, state = scratch_path(spark, "keyed-majority"), scratch_path(spark, "keyed-majority-state")
    handle = st.keyed_majority_stream(
        spark, out, state, "user_id", "bigint", "event_id", "code", 5, 20
    )

    def consume(stream, checkpoint):
        drain_batches(stream, handle, checkpoint)

    halves(spark, coded_events(spark, sf).select("event_id", "user_id", "code"), "event_id", consume)
    return spark.read.parquet(out).select(
        "event_id", "user_id", "seen", "pred", F.round("accuracy", 9).alias("accuracy")
    )


@query(
    "c1_snapshot_stream",
    "WITH half AS (SELECT max(event_id) // 2 AS h FROM events), "
    + f"{CODED_SQL}, r AS (SELECT event_id + 1 AS valid_from, {counts_sql('ORDER BY event_id')} FROM e), "
    + f"s AS (SELECT valid_from // 500 AS b, {ARGMAX_SQL} AS model FROM r WHERE valid_from % 500 = 0) "
    "SELECT event_id, CAST(coalesce(model, 0) AS INTEGER) AS pred FROM e LEFT JOIN s ON event_id // 500 = b",
)
def c1_stream(spark, sf):
    out = scratch_path(spark, "snapshot-scored")
    published = materialise(snapshots_of(spark, sf, 500), "majority-snapshots")
    handle = st.latest_model_stream(
        out,
        "event_id",
        lambda: published,
        lambda rows: rows.select("event_id", connect.majority_vote(F.col("model")).alias("pred")),
    )
    halves(
        spark,
        coded_events(spark, sf).select("event_id"),
        "event_id",
        lambda stream, checkpoint: drain_batches(stream, handle, checkpoint),
    )
    return spark.read.parquet(out).select("event_id", "pred")


SECOND_HALF_SQL = "(vec_id >= (SELECT max(vec_id) // 2 FROM embeddings))::INTEGER"


@query(
    "m1_naive_bayes_stream",
    nb_scored_sql(SECOND_HALF_SQL) + "SELECT vec_id, label, pred FROM p2",
)
def m1_stream(spark, sf):
    out, state = scratch_path(spark, "bayes"), scratch_path(spark, "bayes-state")
    handle = st.bayes_stream(spark, out, state, "embedding", "label", WIDTH, range(CLASSES))
    halves(
        spark,
        table(spark, sf, "embeddings"),
        "vec_id",
        lambda stream, checkpoint: drain_batches(stream, handle, checkpoint),
    )
    return spark.read.parquet(out).select("vec_id", "label", "pred")


@query(
    "j1_gather_stream",
    "SELECT event_id, CAST(event_id % 5 AS DOUBLE) AS x0, CAST(event_id % 3 AS DOUBLE) AS x1, 1 AS complete FROM events",
)
def j1_stream(spark, sf):
    out = scratch_path(spark, "gathered")
    events = table(spark, sf, "events").select("event_id", "ts", "value")

    def consume(stream, checkpoint):
        base = [F.col("event_id"), F.col("ts"), F.col("value").alias("actual")]
        tagged = connect.tag_predictions(
            [
                stream.select(*base, F.pmod("event_id", F.lit(k)).cast("double").alias("pred"))
                for k in (5, 3)
            ],
            ["event_id", "ts", "actual", "pred"],
        )
        drain(st.gather_stream(tagged, "ts", 2, by=["event_id"]), out, checkpoint)

    halves(spark, events, "event_id", consume, end_of_input(events, "ts", 1 + 30000))
    return spark.read.parquet(out).select(
        "event_id",
        F.col("features")[0].alias("x0"),
        F.col("features")[1].alias("x1"),
        F.col("complete").cast("int").alias("complete"),
    )

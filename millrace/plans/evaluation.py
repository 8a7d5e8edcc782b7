"""Keyed results, snapshot joins, windows and metrics over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import features as fx
from millrace.learners.baseline import majority_class
from millrace.learners.ensemble import majority_snapshots
from millrace.operators import connect, keyed, metrics, windows
from millrace.operators.order import full_count_windows, with_rank
from millrace.operators.scan import State, running
from millrace.plans.preparation import EVENT_CODES, EVENT_CODES_SQL
from millrace.plans.registry import query, table
from millrace.runtime import materialise

# Events with their class code. event_id is a gapless counter.
CODED_SQL = f"e AS (SELECT event_id, user_id, value, ts, code FROM events JOIN {EVENT_CODES_SQL} USING (event_type))"


def coded_events(spark, sf):
    code = F.coalesce(*[F.when(F.col("event_type") == n, F.lit(c)) for n, c in EVENT_CODES])
    return table(spark, sf, "events").select(
        "event_id", "user_id", "value", "ts", code.alias("code")
    )


def counts_sql(over: str) -> str:
    return ", ".join(
        f"coalesce(sum(CASE WHEN code = {c} THEN 1 ELSE 0 END) OVER ({over}), 0) AS c{c}"
        for _, c in EVENT_CODES
    )


ARGMAX_SQL = (
    "CASE WHEN c0 >= greatest(c1, c2, c3, c4) THEN 0 WHEN c1 >= greatest(c2, c3, c4) THEN 1 "
    "WHEN c2 >= greatest(c3, c4) THEN 2 WHEN c3 >= c4 THEN 3 ELSE 4 END"
)

# --- unions, keys, joins ------------------------------------------------------


@query(
    "u1_union",
    "SELECT event_id AS v FROM events UNION ALL SELECT event_id * 2 FROM events "
    "UNION ALL SELECT event_id * 4 FROM events",
)
def u1(spark, sf):
    base = table(spark, sf, "events")
    parts = [base.select((F.col("event_id") * k).alias("v")) for k in (1, 2, 4)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("g1_keyed_count", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def g1(spark, sf):
    return keyed.keyed_count(table(spark, sf, "events"), ["user_id"])


@query(
    "g2_rolling_maxby",
    "WITH r AS (SELECT event_id, user_id, value, "
    "max(value) OVER (PARTITION BY user_id ORDER BY event_id) AS top_value FROM events) "
    "SELECT r.event_id, r.user_id, r.value, top_value, "
    "min(CASE WHEN value = top_value THEN event_id END) "
    "OVER (PARTITION BY user_id, top_value ORDER BY event_id) AS top_event_id FROM r",
)
def g2(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return keyed.rolling_max_by(events, ["user_id"], "event_id", "value").select(
        "event_id", "user_id", "value", "top_value", "top_event_id"
    )


@query(
    "g2_final_maxby",
    "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1",
)
def g2_final(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return keyed.final_max_by(events, ["user_id"], "event_id", "value")


def snapshots_of(spark, sf, every):
    ranked = with_rank(coded_events(spark, sf), "event_id", dense_from=0)
    return majority_snapshots(ranked, "rank", "code", range(5), every)


# Snapshots after every 500 rows; one in three is withheld to make gaps.
SNAPS_SQL = (
    f"WITH {CODED_SQL}, "
    f"r AS (SELECT event_id + 1 AS valid_from, {counts_sql('ORDER BY event_id')} FROM e), "
    f"s AS (SELECT valid_from, {ARGMAX_SQL} AS model FROM r WHERE valid_from % 500 = 0 "
    "AND (valid_from // 500) % 3 <> 0) "
)


@query(
    "c1_snapshot_asof",
    SNAPS_SQL + "SELECT event_id, code, CASE WHEN model = code THEN 1 ELSE 0 END AS correct "
    "FROM e ASOF LEFT JOIN s ON e.event_id >= s.valid_from WHERE model IS NOT NULL "
    "UNION ALL SELECT event_id, code, CASE WHEN code = 0 THEN 1 ELSE 0 END FROM e "
    "WHERE event_id < (SELECT min(valid_from) FROM s)",
)
def c1(spark, sf):
    snaps = snapshots_of(spark, sf, 500).filter("version % 3 <> 0")
    rows = connect.with_latest(
        coded_events(spark, sf).select("event_id", "code"), "event_id", {"model": snaps}
    )
    right = connect.majority_vote(F.col("model")) == F.col("code")
    return rows.select("event_id", "code", right.cast("int").alias("correct"))


@query(
    "c2_gate",
    SNAPS_SQL + "SELECT event_id, CAST(model AS INTEGER) AS pred "
    "FROM e ASOF JOIN s ON e.event_id >= s.valid_from",
)
def c2(spark, sf):
    snaps = snapshots_of(spark, sf, 500).filter("version % 3 <> 0")
    rows = connect.with_latest(
        coded_events(spark, sf).select("event_id"), "event_id", {"model": snaps}, gate=True
    )
    return rows.select("event_id", connect.majority_vote(F.col("model")).alias("pred"))


@query(
    "c3_default_model",
    f"WITH {CODED_SQL}, r AS (SELECT event_id + 1 AS valid_from, "
    f"{counts_sql('ORDER BY event_id')} FROM e), "
    f"s AS (SELECT valid_from // 500 AS b, {ARGMAX_SQL} AS model FROM r WHERE valid_from % 500 = 0) "
    "SELECT event_id, CAST(coalesce(model, 0) AS INTEGER) AS pred FROM e LEFT JOIN s ON event_id // 500 = b",
)
def c3(spark, sf):
    events = with_rank(coded_events(spark, sf).select("event_id"), "event_id", dense_from=0)
    rows = connect.with_latest_regular(events, "rank", snapshots_of(spark, sf, 500), 500, "model")
    return rows.select("event_id", connect.majority_vote(F.col("model")).alias("pred"))


def _pair_sql(every: int, label: str) -> str:
    return (
        f"SELECT event_id + 1 AS valid_from, sum(CASE WHEN {label} THEN 0 ELSE 1 END) "
        f"OVER (ORDER BY event_id) AS c0, sum(CASE WHEN {label} THEN 1 ELSE 0 END) "
        f"OVER (ORDER BY event_id) AS c1 FROM events QUALIFY valid_from % {every} = 0"
    )


@query(
    "c4_flag_chain",
    f"WITH s1 AS ({_pair_sql(300, 'value > 250')}), s2 AS ({_pair_sql(500, 'value > 240')}), "
    f"s3 AS ({_pair_sql(700, 'user_id % 2 = 0')}) "
    "SELECT event_id, CASE WHEN s1.c0 >= s1.c1 THEN 1 ELSE 0 END AS f1, "
    "CASE WHEN s2.c0 >= s2.c1 THEN 1 ELSE 0 END AS f2, CASE WHEN s3.c0 >= s3.c1 THEN 1 ELSE 0 END AS f3 "
    "FROM events ASOF JOIN s1 ON event_id >= s1.valid_from ASOF JOIN s2 ON event_id >= s2.valid_from "
    "ASOF JOIN s3 ON event_id >= s3.valid_from",
)
def c4(spark, sf):
    events = with_rank(
        table(spark, sf, "events").select("event_id", "value", "user_id"),
        "event_id",
        dense_from=0,
    )
    labels = {
        "m1": (300, F.col("value") > 250),
        "m2": (500, F.col("value") > 240),
        "m3": (700, F.col("user_id") % 2 == 0),
    }
    snaps = {
        name: majority_snapshots(
            events.withColumn("y", cond.cast("int")), "rank", "y", (0, 1), every
        )
        for name, (every, cond) in labels.items()
    }
    rows = connect.with_latest(events.select("event_id"), "event_id", snaps, gate=True)
    rows = connect.append_flags(rows, [F.col(m) for m in labels])
    return rows.select(
        "event_id", *[F.col("flags")[i].cast("int").alias(f"f{i + 1}") for i in range(3)]
    )


@query(
    "j1_gather",
    "SELECT event_id, CAST(event_id % 5 AS DOUBLE) AS x0, CAST(user_id % 3 AS DOUBLE) AS x1, "
    "CASE WHEN value > 100 THEN CAST(floor(value) AS DOUBLE) ELSE 0.0 END AS x2, "
    "CASE WHEN value > 100 THEN 1 ELSE 0 END AS complete FROM events",
)
def j1(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    actual = F.col("value").alias("actual")
    models = [
        events.select("event_id", actual, (F.col("event_id") % 5).cast("double").alias("pred")),
        events.select("event_id", actual, (F.col("user_id") % 3).cast("double").alias("pred")),
        events.filter("value > 100").select(
            "event_id", actual, F.floor("value").cast("double").alias("pred")
        ),
    ]
    tagged = connect.tag_predictions(models, ["event_id", "actual", "pred"])
    return connect.gather(tagged, 3, ["event_id"]).select(
        "event_id",
        *[F.col("features")[i].alias(f"x{i}") for i in range(3)],
        F.col("complete").cast("int").alias("complete"),
    )


# --- windows ------------------------------------------------------------------

HOUR = 3600
SECOND_SQL = "CAST(floor(epoch(ts)) AS BIGINT)"


def windows_sql(size: int, slide: int) -> str:
    """Every (window, row) pair of sliding windows."""
    return (
        f"m AS (SELECT e.*, s - k * {slide} AS window_start FROM "
        f"(SELECT *, {SECOND_SQL} // {slide} * {slide} AS s, {SECOND_SQL} AS sec FROM events) e, "
        f"range(0, {size // slide}) t(k))"
    )


@query(
    "w1_sliding_members",
    f"WITH {windows_sql(6 * HOUR, HOUR)} SELECT event_id, CAST(window_start AS BIGINT) AS window_start, "
    f"CAST(window_start + {6 * HOUR} AS BIGINT) AS window_end FROM m",
)
def w1(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return windows.window_members(events, "ts", 6 * HOUR, HOUR).select(
        "event_id", "window_start", "window_end"
    )


def _flattened(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id",
        "ts",
        fx.vector(["value", "user_id"]).alias("features"),
        fx.vector(["value"]).alias("targets"),
    )
    return windows.flatten_windows(
        rows, "ts", "event_id", "features", "targets", 3 * HOUR, HOUR, 40
    )


@query(
    "w2_flatten",
    f"WITH {windows_sql(3 * HOUR, HOUR)}, r AS (SELECT *, row_number() OVER "
    "(PARTITION BY window_start ORDER BY ts, event_id) AS rn FROM m) "
    "SELECT CAST(window_start AS BIGINT) AS window_start, count(*) AS n, count(*) - 40 AS overflow, "
    "round(sum(CASE WHEN rn <= 40 THEN value * (2 * rn - 1) + user_id * (2 * rn) END), 4) AS weighted, "
    "max(CASE WHEN rn = 40 THEN value END) AS target FROM r GROUP BY window_start HAVING count(*) >= 40",
)
def w2(spark, sf):
    full, _ = _flattened(spark, sf)
    places = F.sequence(F.lit(1), F.size("features"))
    weighted = F.aggregate(
        F.zip_with("features", places, lambda x, i: x * i), F.lit(0.0), lambda acc, v: acc + v
    )
    return full.select(
        "window_start",
        "n",
        "overflow",
        F.round(weighted, 4).alias("weighted"),
        F.col("targets")[0].alias("target"),
    )


@query(
    "w3_short_windows",
    f"WITH {windows_sql(3 * HOUR, HOUR)} SELECT CAST(window_start AS BIGINT) AS window_start, "
    f"CAST(window_start + {3 * HOUR} AS BIGINT) AS window_end, count(*) AS n FROM m "
    "GROUP BY window_start HAVING count(*) < 40",
)
def w3(spark, sf):
    _, short = _flattened(spark, sf)
    return short.select("window_start", "window_end", "n")


@query(
    "w4_tumbling",
    f"SELECT CAST({SECOND_SQL} // {HOUR} * {HOUR} AS BIGINT) AS window_start, count(*) AS n, "
    "round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def w4(spark, sf):
    aggs = [F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")]
    return windows.tumbling(table(spark, sf, "events"), "ts", HOUR, aggs)


@query(
    "w5_count_window",
    "SELECT b AS block, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM "
    "(SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 700 AS b, o_totalprice FROM orders) "
    "GROUP BY b HAVING count(*) = 700",
)
def w5(spark, sf):
    ranked = with_rank(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    return full_count_windows(
        ranked, "rank", 700, F.round(F.avg("o_totalprice"), 4).alias("mean")
    )


@query(
    "w8_late_audit",
    "SELECT o_orderkey FROM (SELECT o_orderkey, o_orderdate, max(o_orderdate) OVER "
    "(ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM orders) "
    "WHERE o_orderdate < seen - INTERVAL 900 DAY",
)
def w8(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return windows.late_rows(orders, "o_orderdate", "o_orderkey", 900 * 86400).select("o_orderkey")


# --- metrics ------------------------------------------------------------------


def majority_scored(spark, sf):
    return majority_class(coded_events(spark, sf), "event_id", "code", range(5))


MAJORITY_SQL = (
    f"WITH {CODED_SQL}, r AS (SELECT *, "
    + counts_sql("ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    + f" FROM e), p AS (SELECT event_id, user_id, value, ts, code, {ARGMAX_SQL} AS pred FROM r) "
)
KEYED_MAJORITY_SQL = (
    f"WITH {CODED_SQL}, r AS (SELECT *, "
    + counts_sql(
        "PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    )
    + ", row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seen"
    + f" FROM e), p AS (SELECT *, {ARGMAX_SQL} AS pred FROM r) "
)


@query(
    "a1_accuracy",
    MAJORITY_SQL + "SELECT event_id, event_id + 1 AS seen, CAST(sum(CASE WHEN pred = code THEN 1 ELSE 0 END) "
    "OVER (ORDER BY event_id) AS BIGINT) AS hits, round(hits / seen, 9) AS accuracy FROM p",
)
def a1(spark, sf):
    # written once: the scan reads its input twice
    scored = materialise(
        majority_scored(spark, sf).select("event_id", "code", "pred"), "majority-scored"
    )
    out = metrics.prequential_accuracy(scored, "event_id", F.col("pred") == F.col("code"))
    return out.select("event_id", "seen", "hits", F.round("accuracy", 9).alias("accuracy"))


@query(
    "a2_warmup_accuracy",
    KEYED_MAJORITY_SQL + "SELECT event_id, user_id, seen, round(sum(CASE WHEN pred = code THEN 1 ELSE 0 END) "
    "OVER (PARTITION BY user_id ORDER BY event_id) / (seen - 19), 9) AS accuracy FROM p WHERE seen >= 20",
)
def a2(spark, sf):
    scored = majority_class(
        coded_events(spark, sf), "event_id", "code", range(5), ["user_id"], seen="seen"
    )
    stored = materialise(
        scored.select("event_id", "user_id", "seen", "code", "pred"), "majority-scored"
    )
    right = F.col("pred") == F.col("code")
    out = metrics.warmup_accuracy(stored, "event_id", right, 20, ["user_id"], seen="seen")
    return out.select("event_id", "user_id", "seen", F.round("accuracy", 9).alias("accuracy"))


def ewma_sql(bias: str) -> str:
    left = "pow(0.9, n)" if bias == "power" else "pow(0.9, pow(2.0, least(n - 1, 60)))"
    # 0.9^400 is below 1e-18: older rows cannot change the rounded value
    return (
        "WITH c AS (SELECT event_id, event_id + 1 AS n, list(CASE WHEN value > 250 THEN 1.0 ELSE 0.0 END) "
        "OVER (ORDER BY event_id ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) AS l FROM events), "
        "r AS (SELECT event_id, n, 0.1 * list_sum(list_transform(l, lambda x, i: "
        "x * pow(0.9, len(l) - i))) AS raw FROM c) "
        f"SELECT event_id, round(raw, 9) AS raw, round(raw / (1 - {left}), 9) AS corrected FROM r"
    )


def _ewma(spark, sf, bias):
    ranked = with_rank(
        table(spark, sf, "events").select("event_id", "value"), "event_id", dense_from=0
    )
    out = metrics.ewma_accuracy(ranked, "rank", F.col("value") > 250, 0.9, bias)
    return out.select(
        "event_id", F.round("raw", 9).alias("raw"), F.round("corrected", 9).alias("corrected")
    )


@query("a3_ewma", ewma_sql("power"))
def a3(spark, sf):
    return _ewma(spark, sf, "power")


@query("a3_ewma_squaring", ewma_sql("squaring"))
def a3_squaring(spark, sf):
    return _ewma(spark, sf, "squaring")


@query(
    "a4_window_accuracy",
    MAJORITY_SQL + "SELECT event_id // 500 AS block, round(avg(CASE WHEN pred = code THEN 1.0 ELSE 0.0 END), 9) "
    "AS accuracy FROM p GROUP BY 1 HAVING count(*) = 500",
)
def a4(spark, sf):
    ranked = with_rank(majority_scored(spark, sf), "event_id", dense_from=0)
    out = metrics.window_accuracy(ranked, "rank", F.col("pred") == F.col("code"), 500)
    return out.select("block", F.round("accuracy", 9).alias("accuracy"))


def exact_mean(mean: str, n: str):
    """A mean to six places. Its sum has three decimals; rounding the sum first
    takes out the order of the additions, which decides ties otherwise."""
    return F.round(F.round(F.col(mean) * F.col(n), 3) / F.col(n), 6).alias(mean)


def paired_outputs(spark, sf):
    """Two outputs per event: its value against the mean level, and half of it
    against the user number."""
    return table(spark, sf, "events").select(
        "event_id",
        fx.vector([F.col("value"), F.col("value") / 2]).alias("actual"),
        fx.vector([F.lit(250.0), F.col("user_id")]).alias("pred"),
    )


@query(
    "a5_mae_outputs",
    "WITH r AS (SELECT event_id, event_id + 1 AS n, round(sum(abs(value - 250)) OVER (ORDER BY event_id), 3) AS a, "
    "round(sum(abs(value / 2 - user_id)) OVER (ORDER BY event_id), 3) AS b FROM events) "
    "SELECT event_id, 0 AS output, round(a / n, 6) AS mae FROM r "
    "UNION ALL SELECT event_id, 1, round(b / n, 6) FROM r",
)
def a5(spark, sf):
    out = metrics.running_mae(paired_outputs(spark, sf), "event_id", "actual", "pred", 2)
    return out.select("event_id", "output", exact_mean("mae", "seen"))


@query(
    "a5_mae_progress",
    "WITH r AS (SELECT event_id + 1 AS seen, round(sum(abs(value - 250)) OVER (ORDER BY event_id), 3) AS a, "
    "round(sum(abs(value / 2 - user_id)) OVER (ORDER BY event_id), 3) AS b FROM events) "
    "SELECT seen, 0 AS output, round(a / seen, 6) AS mae FROM r WHERE seen % 1000 = 0 "
    "UNION ALL SELECT seen, 1, round(b / seen, 6) FROM r WHERE seen % 1000 = 0",
)
def a5_progress(spark, sf):
    ranked = with_rank(paired_outputs(spark, sf), "event_id", dense_from=0)
    out = metrics.error_progress(ranked, "rank", "actual", "pred", 2, 1000)
    return out.select("seen", "output", exact_mean("mae", "seen"))


@query(
    "a6_mae_total",
    "WITH r AS (SELECT event_id + 1 AS seen, round(sum(abs(value - 250) + abs(value / 2 - user_id)) "
    "OVER (ORDER BY event_id), 3) AS m FROM events) "
    "SELECT seen, round(m / seen, 6) AS mae FROM r WHERE seen % 1000 = 0",
)
def a6(spark, sf):
    ranked = with_rank(paired_outputs(spark, sf), "event_id", dense_from=0)
    out = metrics.total_mae_progress(ranked, "rank", "actual", "pred", 1000)
    return out.select("seen", exact_mean("mae", "seen"))


def level_pairs(spark, sf):
    """Level of each value and, as its prediction, of the user's value before."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    prev = running(
        events, "event_id", {"before": State(F.col("value"), "last")}, ["user_id"], inclusive=False
    )
    return prev.select(
        "event_id",
        fx.bin_levels(F.col("value"), 350, 450).alias("actual"),
        fx.bin_levels(F.col("before"), 350, 450).alias("pred"),
    )


LEVEL_PAIRS_SQL = (
    "WITH b AS (SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before "
    "FROM events), l AS (SELECT event_id, CASE WHEN value >= 450 THEN 2 WHEN value >= 350 THEN 1 ELSE 0 END AS actual, "
    "CASE WHEN before >= 450 THEN 2 WHEN before >= 350 THEN 1 WHEN before IS NOT NULL THEN 0 END AS pred FROM b) "
)


@query(
    "a7_confusion",
    LEVEL_PAIRS_SQL + "SELECT a.v AS actual, p.v AS pred, count(l.event_id) AS n FROM "
    "(VALUES (0),(1),(2)) a(v) CROSS JOIN (VALUES (0),(1),(2)) p(v) "
    "LEFT JOIN l ON l.actual = a.v AND l.pred = p.v GROUP BY a.v, p.v",
)
def a7(spark, sf):
    return metrics.confusion_matrix(level_pairs(spark, sf), F.col("actual"), F.col("pred"), 3)


@query(
    "a7_unpaired",
    LEVEL_PAIRS_SQL + "SELECT count(*) AS n FROM l WHERE actual IS NULL OR pred IS NULL",
)
def a7_unpaired(spark, sf):
    return metrics.unpaired_count(level_pairs(spark, sf), F.col("actual"), F.col("pred"))


@query(
    "a7_running_confusion",
    LEVEL_PAIRS_SQL
    + "SELECT event_id, "
    + ", ".join(
        f"CAST(sum(CASE WHEN actual = {a} AND pred = {p} THEN 1 ELSE 0 END) OVER (ORDER BY event_id) "
        f"AS BIGINT) AS c{a}{p}"
        for a in range(3)
        for p in range(3)
    )
    + " FROM l WHERE pred IS NOT NULL",
)
def a7_running(spark, sf):
    pairs = level_pairs(spark, sf).filter("pred is not null")
    out = metrics.running_confusion(pairs, "event_id", F.col("actual"), F.col("pred"), 3)
    return out.drop("actual", "pred")


@query(
    "a8_vector_avg",
    f"WITH {windows_sql(6 * HOUR, HOUR)}, x AS (SELECT window_start, 0 AS i, value AS v FROM m "
    "UNION ALL SELECT window_start, 1, CAST(user_id AS DOUBLE) FROM m) "
    "SELECT CAST(window_start AS BIGINT) AS window_start, i, round(round(sum(v), 3) / count(*), 6) AS mean, count(*) AS n "
    "FROM x GROUP BY window_start, i",
)
def a8(spark, sf):
    rows = table(spark, sf, "events").select("ts", fx.vector(["value", "user_id"]).alias("v"))
    out = windows.window_vector_average(rows, "ts", "v", 6 * HOUR, HOUR)
    return out.select("window_start", "i", exact_mean("mean", "n"), "n")


@query(
    "a8_vector_avg_keyed",
    "SELECT label, i - 1 AS i, round(avg(embedding[i]), 6) AS mean FROM embeddings, range(1, 65) r(i) "
    "GROUP BY label, i",
)
def a8_keyed(spark, sf):
    out = metrics.vector_average(table(spark, sf, "embeddings"), "embedding", ["label"])
    return out.select("label", F.posexplode("mean").alias("i", "m")).select(
        "label", F.col("i").cast("bigint").alias("i"), F.round("m", 6).alias("mean")
    )


@query("a9_examples_seen", "SELECT event_id // 1000 AS block, event_id // 1000 * 1000 + count(*) AS seen FROM events GROUP BY 1 HAVING count(*) = 1000")
def a9(spark, sf):
    ranked = with_rank(table(spark, sf, "events").select("event_id"), "event_id", dense_from=0)
    return metrics.progress(ranked, "rank", 1000, {})

"""Sources, sinks and feature preparation over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import features as fx
from millrace.functions.constants import METHANE_ALARM, METHANE_WARNING
from millrace.functions.spec import Feature, FeatureSpec, learn_vocabulary
from millrace.operators.metrics import accuracy_progress
from millrace.operators.order import with_rank
from millrace.plans.registry import query, table
from millrace.runtime import scratch_path
from millrace.sources import sinks, tables

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


def slots_text(vec):
    """0/1 slots as text, so that the result holds plain columns."""
    return F.array_join(F.transform(vec, lambda x: x.cast("int").cast("string")), ",")


# --- sources and sinks ------------------------------------------------------


@query(
    "s1_csv_roundtrip",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
)
def s1(spark, sf):
    path = scratch_path(spark, "orders-csv")
    out = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    sinks.write_csv(out, path)
    return tables.read_csv(spark, path, out.schema)


@query(
    "s1_line_order",
    "SELECT count(*) AS n, min(rn) AS lo, max(rn) AS hi, count(DISTINCT rn) AS distinct_lines "
    "FROM (SELECT row_number() OVER (ORDER BY event_id) - 1 AS rn FROM events)",
)
def s1_lines(spark, sf):
    path = scratch_path(spark, "events-csv")
    out = table(spark, sf, "events").select("event_id", "value")
    sinks.write_csv(out, path)
    numbered = tables.line_order(tables.read_csv(spark, path, out.schema))
    return numbered.agg(
        F.count("*").alias("n"),
        F.min("seq").alias("lo"),
        F.max("seq").alias("hi"),
        F.count_distinct("seq").alias("distinct_lines"),
    )


EVENT_CODES = (("click", 0), ("error", 1), ("purchase", 2), ("signup", 3), ("view", 4))
EVENT_CODES_SQL = (
    "(VALUES ('click',0),('error',1),('purchase',2),('signup',3),('view',4)) AS c(event_type, code)"
)


@query(
    "s2_literals",
    "SELECT CAST(code AS INTEGER) AS code, count(*) AS n, round(sum(value), 2) AS total "
    f"FROM events JOIN {EVENT_CODES_SQL} USING (event_type) GROUP BY code",
)
def s2(spark, sf):
    codes = tables.literal_rows(spark, EVENT_CODES, "event_type string, code int")
    return (
        table(spark, sf, "events")
        .join(F.broadcast(codes), "event_type")  # five literal rows
        .groupBy("code")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    )


@query(
    "s3_sequence",
    "SELECT id, value FROM range(1, (SELECT max(event_id) + 2 FROM events)) r(id) "
    "LEFT JOIN events ON event_id = id",
)
def s3(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    last = events.agg(F.max("event_id")).first()[0]
    ids = tables.sequence(spark, 1, last + 1)
    return ids.join(events, ids["id"] == events["event_id"], "left").select("id", "value")


@query(
    "s4_train_test",
    "SELECT role, label, count(*) AS n FROM "
    "(SELECT 'train' AS role, label FROM embeddings UNION ALL SELECT 'test', label FROM embeddings) "
    "GROUP BY role, label",
)
def s4(spark, sf):
    train, test = tables.train_and_test(table(spark, sf, "embeddings"))
    return train.unionByName(test).groupBy("role", "label").agg(F.count("*").alias("n"))


@query(
    "s5_synthetic_time",
    "SELECT o_orderkey, seq, seq * 1000 AS event_ms FROM "
    "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS seq FROM orders)",
)
def s5(spark, sf):
    out = tables.with_synthetic_time(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return out.select("o_orderkey", "seq", F.unix_millis("event_time").alias("event_ms"))


@query(
    "k1_csv_sink",
    "SELECT CAST(actual AS INTEGER) AS actual, CAST(pred AS INTEGER) AS pred, count(*) AS n FROM ("
    "SELECT CASE WHEN value >= 400 THEN 2 WHEN value >= 100 THEN 1 ELSE 0 END AS actual, "
    "CASE WHEN event_type = 'error' THEN 2 WHEN event_type = 'click' THEN 1 ELSE 0 END AS pred "
    "FROM events) GROUP BY actual, pred",
)
def k1(spark, sf):
    pairs = table(spark, sf, "events").select(
        fx.bin_levels(F.col("value"), 100, 400).alias("actual"),
        F.when(F.col("event_type") == "error", 2)
        .when(F.col("event_type") == "click", 1)
        .otherwise(0)
        .alias("pred"),
    )
    path = sinks.write_csv(pairs, scratch_path(spark, "pairs"))
    back = tables.read_csv(spark, path, "actual int, pred int")
    return back.groupBy("actual", "pred").agg(F.count("*").alias("n"))


@query(
    "k3_side_output",
    "SELECT tag, event_type, count(*) AS n FROM ("
    "SELECT 'main' AS tag, event_type FROM events "
    "UNION ALL SELECT 'errors', event_type FROM events WHERE event_type = 'error' "
    "UNION ALL SELECT 'high', event_type FROM events WHERE value > 400) GROUP BY tag, event_type",
)
def k3(spark, sf):
    marked = sinks.tagged(
        table(spark, sf, "events").select("event_type", "value"),
        {"errors": F.col("event_type") == "error", "high": F.col("value") > 400},
    )
    path = sinks.write_named_outputs(marked, scratch_path(spark, "named"))
    back = spark.read.parquet(path)
    return back.groupBy("tag", "event_type").agg(F.count("*").alias("n"))


@query(
    "k4_progress",
    "WITH r AS (SELECT event_id + 1 AS n, sum(CASE WHEN value > 250 THEN 1 ELSE 0 END) "
    "OVER (ORDER BY event_id) AS h FROM events) "
    "SELECT CAST(n AS BIGINT) AS seen, CAST(h AS BIGINT) AS hits, round(h / n, 9) AS accuracy "
    "FROM r WHERE n % 1000 = 0",
)
def k4(spark, sf):
    ranked = with_rank(table(spark, sf, "events"), "event_id", dense_from=0)
    out = accuracy_progress(ranked, "rank", F.col("value") > 250, 1000)
    return out.select("seen", "hits", F.round("accuracy", 9).alias("accuracy"))


@query(
    "k6_final_report",
    "SELECT count(*) AS seen, count(*) FILTER (WHERE value > 250) AS hits, "
    "round(avg(CASE WHEN value > 250 THEN 1.0 ELSE 0.0 END), 9) AS accuracy, "
    "round(round(sum(abs(value - 250)), 2) / count(*), 6) AS mae FROM events",
)
def k6(spark, sf):
    right = F.col("value") > 250
    return table(spark, sf, "events").agg(
        F.count("*").alias("seen"),
        F.count_if(right).alias("hits"),
        F.round(F.avg(right.cast("double")), 9).alias("accuracy"),
        F.round(F.round(F.sum(F.abs(F.col("value") - 250)), 2) / F.count("*"), 6).alias("mae"),
    )


# --- projections ------------------------------------------------------------


@query(
    "p1_parse_reject",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS ok, "
    "CASE WHEN event_type = 'error' THEN NULL ELSE round(value + user_id, 6) END AS total, "
    "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad_cells FROM events",
)
def p1(spark, sf):
    cells = table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("'"), F.col("value").cast("string"), F.lit("'")).alias("a"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("user_id").cast("string"))
        .alias("b"),
    )
    good, bad = fx.split_rejected(cells, ["a", "b"])
    return good.select(
        "event_id",
        F.lit(1).alias("ok"),
        F.round(F.col("a") + F.col("b"), 6).alias("total"),
        F.lit(0).alias("bad_cells"),
    ).unionByName(
        bad.select(
            "event_id", F.lit(0).alias("ok"), F.lit(None).cast("double").alias("total"), "bad_cells"
        )
    )


@query(
    "p2_binary_label",
    "SELECT doc_id, CASE WHEN quality = 1 THEN 0 ELSE 1 END AS label FROM labels",
)
def p2(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id", fx.equals_label(F.col("quality")).alias("label")
    )


@query(
    "p3_shift_label",
    "SELECT l_orderkey, l_partkey, CAST(l_linenumber - 1 AS INTEGER) AS label FROM lineitem",
)
def p3(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", fx.zero_based_label(F.col("l_linenumber")).alias("label")
    )


@query(
    "p4_threshold_label",
    "SELECT o_orderkey, CASE WHEN o_totalprice <= 250000 THEN 0 ELSE 1 END AS label FROM orders",
)
def p4(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", fx.threshold_label(F.col("o_totalprice"), 250000).alias("label")
    )


@query(
    "p5_onehot",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1,0,0,0' "
    "WHEN '2-HIGH' THEN '0,1,0,0' WHEN '3-MEDIUM' THEN '0,0,1,0' "
    "WHEN '4-NOT SPECIFIED' THEN '0,0,0,1' ELSE '0,0,0,0' END AS slots FROM orders",
)
def p5(spark, sf):
    hot = fx.one_hot(F.col("o_orderpriority"), PRIORITIES)
    return table(spark, sf, "orders").select("o_orderkey", slots_text(hot).alias("slots"))


@query(
    "p5_onehot_learned",
    "WITH v AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS slot "
    "FROM (SELECT DISTINCT c_mktsegment FROM customer)) "
    "SELECT c_custkey, CAST(slot AS INTEGER) AS slot, CAST((SELECT count(*) FROM v) AS INTEGER) AS slots "
    "FROM customer JOIN v USING (c_mktsegment)",
)
def p5_learned(spark, sf):
    customer = table(spark, sf, "customer")
    words = learn_vocabulary(customer, "c_mktsegment")
    hot = fx.one_hot(F.col("c_mktsegment"), words)
    return customer.select(
        "c_custkey",
        F.array_position(hot, 1.0).cast("int").alias("slot"),
        F.size(hot).alias("slots"),
    )


@query(
    "p6_ordinal_onehot",
    "SELECT l_orderkey, l_partkey, CASE l_linenumber WHEN 1 THEN '1,0,0,0,0' "
    "WHEN 2 THEN '0,1,0,0,0' WHEN 3 THEN '0,0,1,0,0' WHEN 4 THEN '0,0,0,1,0' "
    "WHEN 5 THEN '0,0,0,0,1' ELSE '0,0,0,0,0' END AS slots, "
    "CASE WHEN l_linenumber BETWEEN 1 AND 5 THEN 0 ELSE 1 END AS rejected FROM lineitem",
)
def p6(spark, sf):
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        slots_text(fx.one_hot_ordinal(line, 5)).alias("slots"),
        fx.ordinal_out_of_range(line, 5).cast("int").alias("rejected"),
    )


LINE_VECTOR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "p7_norms",
    "SELECT l_orderkey, l_partkey, round(l_quantity / 50.0, 9) AS x0, "
    "round(l_extendedprice / 1000.0, 9) AS x1, round(l_discount / 0.1, 9) AS x2, "
    "round(l_tax / 0.08, 9) AS x3 FROM lineitem",
)
def p7(spark, sf):
    vec = fx.normalise(fx.vector(LINE_VECTOR), (50.0, 1000.0, 0.1, 0.08))
    out = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", vec.alias("v"))
    return out.select(
        "l_orderkey", "l_partkey", *[F.round(F.col("v")[i], 9).alias(f"x{i}") for i in range(4)]
    )


@query(
    "p8_scale",
    "SELECT l_orderkey, l_partkey, round(l_quantity / 60.0, 9) AS x0, "
    "round(l_extendedprice / 60.0, 9) AS x1, round(l_discount / 60.0, 9) AS x2, "
    "round(l_tax / 60.0, 9) AS x3 FROM lineitem",
)
def p8(spark, sf):
    vec = fx.scale(fx.vector(LINE_VECTOR), 60)
    out = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", vec.alias("v"))
    return out.select(
        "l_orderkey", "l_partkey", *[F.round(F.col("v")[i], 9).alias(f"x{i}") for i in range(4)]
    )


@query(
    "p9_split_target",
    "SELECT l_orderkey, round(l_quantity / 50.0, 9) AS f0, round(l_discount, 9) AS f1, "
    "round(l_tax, 9) AS f2, round(l_extendedprice / 100.0, 9) AS t0 FROM lineitem",
)
def p9(spark, sf):
    spec = FeatureSpec(
        columns=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        features=(Feature("l_quantity", divisor=50.0), Feature("l_discount"), Feature("l_tax")),
        targets=("l_extendedprice",),
        target_divisor=100.0,
    )
    out = spec.apply(table(spark, sf, "lineitem"), keep=["l_orderkey"])
    return out.select(
        "l_orderkey",
        *[F.round(F.col("features")[i], 9).alias(f"f{i}") for i in range(3)],
        F.round(F.col("targets")[0], 9).alias("t0"),
    )


@query(
    "p10_event_time",
    "SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS event_second FROM events",
)
def p10(spark, sf):
    parts = table(spark, sf, "events").select(
        "event_id",
        *[
            f("ts").cast("double").alias(n)
            for n, f in (
                ("y", F.year), ("mo", F.month), ("d", F.day),
                ("h", F.hour), ("mi", F.minute), ("s", F.second),
            )
        ],
    )
    return parts.select(
        "event_id",
        F.unix_seconds(fx.event_time("y", "mo", "d", "h", "mi", "s")).alias("event_second"),
    )


@query("p11_unquote", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def p11(spark, sf):
    quoted = F.concat(F.lit("'"), F.col("c_mktsegment"), F.lit("'"))
    return table(spark, sf, "customer").select("c_custkey", fx.unquote(quoted).alias("segment"))


@query(
    "p12_expand",
    "SELECT event_id, value AS x0, CASE WHEN event_id % 4 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS x1, "
    "CASE WHEN event_id % 4 = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS x2, "
    "CASE WHEN event_id % 4 = 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS x3, "
    "CAST(user_id AS DOUBLE) AS x4 FROM events",
)
def p12(spark, sf):
    vec = fx.vector([F.col("value"), F.col("event_id") % 4, F.col("user_id")])
    out = table(spark, sf, "events").select("event_id", fx.expand_slot(vec, 1, 3).alias("v"))
    return out.select("event_id", *[F.col("v")[i].alias(f"x{i}") for i in range(5)])


@query(
    "p13_levels",
    "SELECT event_id, CASE WHEN value / 100.0 >= 1.5 THEN 2 WHEN value / 100.0 >= 1.0 THEN 1 "
    "ELSE 0 END AS level FROM events",
)
def p13(spark, sf):
    level = fx.bin_levels(F.col("value") / 100.0, METHANE_WARNING, METHANE_ALARM)
    return table(spark, sf, "events").select("event_id", level.alias("level"))


@query(
    "p14_long_form",
    "WITH o AS (SELECT event_id, 0 AS output, value AS actual, 250.0::DOUBLE AS pred FROM events "
    "UNION ALL SELECT event_id, 1, value / 2, CAST(user_id AS DOUBLE) FROM events), "
    "l AS (SELECT *, CASE WHEN actual >= 400 THEN 2 WHEN actual >= 100 THEN 1 ELSE 0 END AS level FROM o) "
    "SELECT event_id, CAST(output AS INTEGER) AS output, actual, pred, output || '-' || level AS tag FROM l",
)
def p14(spark, sf):
    wide = table(spark, sf, "events").select(
        "event_id",
        fx.vector([F.col("value"), F.col("value") / 2]).alias("actual"),
        fx.vector([F.lit(250.0), F.col("user_id")]).alias("pred"),
    )
    out = fx.one_row_per_output(wide, "actual", "pred", ["event_id"])
    return out.withColumn("tag", fx.output_tag(F.col("output"), fx.bin_levels(F.col("actual"), 100, 400)))


@query(
    "p15_flags",
    "SELECT event_id, CASE WHEN value > 250 THEN 1.0 ELSE 0.0 END::DOUBLE AS x0, "
    "CASE WHEN user_id % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS x1, "
    "CASE WHEN (event_type = 'error') <> (value > 400) THEN 1 ELSE 0 END AS mismatch FROM events",
)
def p15(spark, sf):
    flags = F.array(F.col("value") > 250, F.col("user_id") % 2 == 0)
    rows = table(spark, sf, "events").select(
        "event_id",
        fx.flags_to_features(flags).alias("v"),
        (F.col("event_type") == "error").cast("int").alias("actual"),
        (F.col("value") > 400).cast("int").alias("label"),
    )
    return rows.select(
        "event_id",
        F.col("v")[0].alias("x0"),
        F.col("v")[1].alias("x1"),
        fx.is_mismatch("actual", "label").cast("int").alias("mismatch"),
    )


@query(
    "p16_filter",
    "SELECT o_orderkey, o_totalprice FROM orders "
    "WHERE month(o_orderdate) < 4 AND day(o_orderdate) < 5 AND o_totalprice > 1000",
)
def p16(spark, sf):
    return (
        table(spark, sf, "orders")
        .filter(
            (F.month("o_orderdate") < 4)
            & (F.day("o_orderdate") < 5)
            & (F.col("o_totalprice") > 1000)
        )
        .select("o_orderkey", "o_totalprice")
    )


@query(
    "p17_maps",
    "SELECT event_id, event_id * 2 AS doubled, event_id * 4 AS quadrupled FROM events",
)
def p17(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", "event_id * 2 AS doubled", "event_id * 4 AS quadrupled"
    )


@query(
    "p18_argmax",
    "SELECT event_id, CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS best "
    "FROM (SELECT event_id, user_id % 5 AS a, event_id % 5 AS b, event_id % 7 AS c FROM events)",
)
def p18(spark, sf):
    votes = fx.vector([F.col("user_id") % 5, F.col("event_id") % 5, F.col("event_id") % 7])
    return table(spark, sf, "events").select("event_id", fx.arg_max(votes).alias("best"))


@query("p19_vote_flag", "SELECT event_id, user_id % 5 >= event_id % 5 AS flag FROM events")
def p19(spark, sf):
    votes = fx.vector([F.col("user_id") % 5, F.col("event_id") % 5])
    return table(spark, sf, "events").select("event_id", fx.binary_vote(votes).alias("flag"))


@query(
    "p20_pad",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1,0,0,0,0,0,0' "
    "WHEN '2-HIGH' THEN '0,1,0,0,0,0,0' WHEN '3-MEDIUM' THEN '0,0,1,0,0,0,0' "
    "WHEN '4-NOT SPECIFIED' THEN '0,0,0,1,0,0,0' ELSE '0,0,0,0,0,0,0' END AS slots, "
    "CASE WHEN o_totalprice <= 250000 THEN 0 ELSE 1 END AS label FROM orders",
)
def p20(spark, sf):
    spec = FeatureSpec(
        columns=("o_orderpriority", "o_totalprice"),
        features=(Feature("o_orderpriority", "vocabulary", vocabulary=PRIORITIES),),
        label=fx.threshold_label(F.col("o_totalprice"), 250000),
        width=7,
    )
    out = spec.apply(table(spark, sf, "orders"), keep=["o_orderkey"])
    return out.select("o_orderkey", slots_text(F.col("features")).alias("slots"), "label")


@query(
    "p21_format",
    "SELECT event_id, 'KEY_' || user_id || ' - ' || event_type AS text FROM events",
)
def p21(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fx.key_text(F.col("user_id"), F.col("event_type")).alias("text")
    )

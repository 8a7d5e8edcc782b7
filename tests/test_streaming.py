import numpy as np
from pyspark.sql import functions as F

from millrace.operators import metrics, windows
from millrace.runtime import scratch_path
from millrace.sources import sinks, tables
from millrace.streaming import operators as st
from millrace.streaming.run import drain, drain_batches, end_of_input, replay, write_named


def timed(spark, n=60):
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.col("id") * 2).alias("ts"),
        F.array((F.col("id") % 7).cast("double")).alias("f"),
        F.array((F.col("id") % 5).cast("double")).alias("t"),
    )


def test_flattened_stream_equals_batch_on_closed_windows(spark):
    df, out = timed(spark), scratch_path(spark, "flat")

    def consume(stream, checkpoint):
        made = st.flatten_stream(stream, "ts", "seq", "f", "t", "10 seconds", "4 seconds", 4)
        drain(made, out, checkpoint)

    replay(spark, df, "seq", [20, 41], consume)
    got = {
        r["s"]: (r["n"], r["features"], r["targets"])
        for r in spark.read.parquet(out)
        .select(F.unix_seconds("window.start").alias("s"), "n", "features", "targets")
        .collect()
    }
    full, short = windows.flatten_windows(df, "ts", "seq", "f", "t", 10, 4, 4)
    closed = 59 * 2
    for r in full.collect():
        if r["window_start"] + 10 <= closed:
            assert got[r["window_start"]] == (r["n"], r["features"], r["targets"])
    for r in short.collect():
        if r["window_end"] <= closed:
            assert got[r["window_start"]] == (r["n"], None, None)


def test_crowded_windows_keep_their_first_rows_and_close_at_the_end(spark):
    """500 rows a window in three disordered arrivals, many Arrow batches a group."""
    df = spark.range(1500).select(
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.expr("pmod(id * 7, 30)")).alias("ts"),
        F.array(F.col("id").cast("double")).alias("f"),
        F.array((F.col("id") % 5).cast("double")).alias("t"),
    )
    out = scratch_path(spark, "crowded")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")

    def consume(stream, checkpoint):
        made = st.flatten_stream(stream, "ts", "seq", "f", "t", "10 seconds", "5 seconds", 3, "40 seconds")
        drain(made, out, checkpoint)

    try:
        replay(spark, df, "seq", [450, 1000], consume, end_of_input(df, "ts", 51))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {
        r["s"]: (r["n"], r["features"], r["targets"])
        for r in spark.read.parquet(out).selectExpr("unix_seconds(window.start) AS s", "*").collect()
    }
    rows = sorted((i * 7 % 30, i) for i in range(1500))
    want = {}
    for start in range(-5, 30, 5):
        of = [i for t, i in rows if start <= t < start + 10]
        want[start] = (len(of), [float(i) for i in of[:3]], [float(of[2] % 5)])
    assert got == want


def test_a_repeated_batch_gives_the_same_state(spark):
    out, state = scratch_path(spark, "rep"), scratch_path(spark, "rep-state")
    handle = st.running_sums(spark, out, state, "seq", {"total": F.col("v")})
    a = spark.createDataFrame([(0, 1.0), (1, 2.0)], "seq long, v double")
    b = spark.createDataFrame([(2, 3.0)], "seq long, v double")
    handle(a, 0)
    handle(b, 1)
    handle(b, 1)  # the engine runs a batch again after a failure
    got = sorted((r["seq"], r["total"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1.0), (1, 3.0), (2, 6.0)]


def test_keyed_linear_stream_equals_the_loop(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, rng.normal(size=2).tolist(), [float(i % 4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, k long, x array<double>, y array<double>")
    out, state = scratch_path(spark, "keyed"), scratch_path(spark, "keyed-state")
    handle = st.keyed_linear_stream(spark, out, state, "k", "bigint", "seq", "x", "y", 2, 1, 0.05)

    def consume(stream, checkpoint):
        drain_batches(stream, handle, checkpoint)

    replay(spark, df, "seq", [25], consume)
    got = {r["seq"]: r["pred"][0] for r in spark.read.parquet(out).collect()}
    for k in range(3):
        w = np.full((3, 1), 0.1)
        for seq, key, x, y in rows:
            if key == k:
                x = np.append(x, 1.0)
                assert abs(got[seq] - (x @ w)[0]) < 1e-12
                w = w + 0.05 * np.outer(x, np.array(y) - x @ w)


def test_keyed_streams_with_a_hot_a_null_and_a_resting_key(spark):
    """One key has most rows of a batch, in many Arrow batches; one rests for a batch;
    a batch that is run again gives the same."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    out, state = scratch_path(spark, "km"), scratch_path(spark, "km-state")
    rows = [(2**60 + i, None if i % 9 == 0 else "hot" if i % 5 else "rest", None if i % 17 == 0 else i * i % 3) for i in range(1200)]
    rows = [r for r in rows if not (r[1] == "rest" and 400 <= r[0] - 2**60 < 800)]
    ddl = "seq long, k string, c int"
    handle = st.keyed_majority_stream(spark, out, state, "k", "string", "seq", "c", 3, 5)
    try:
        for b in (0, 1, 1, 2):
            part = [r for r in rows if (r[0] - 2**60) // 400 == b]
            handle(spark.createDataFrame(part[::-1], ddl).repartition(4), b)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r["seq"]: (r["k"], r["seen"], r["pred"], r["accuracy"]) for r in spark.read.parquet(out).collect()}
    want, seen, hits, counts = {}, {}, {}, {}
    for seq, k, c in rows:
        of = counts.setdefault(k, [0, 0, 0])
        pred = of.index(max(of))
        seen[k] = seen.get(k, 0) + 1
        if seen[k] >= 5:
            hits[k] = hits.get(k, 0) + (pred == c)
            want[seq] = (k, seen[k], pred, hits[k] / (seen[k] - 4))
        if c is not None:
            of[c] += 1
    assert got == want


def test_snapshots_published_during_a_stream_are_used_and_old_ones_not_read(spark):
    out, folder = scratch_path(spark, "late-models"), scratch_path(spark, "published")
    read = []

    def publish(*positions):
        made = spark.createDataFrame([(p, p * 10) for p in positions], "valid_from long, params long")
        made.write.mode("append").parquet(folder)

    def score(rows):
        read.append({r["model"] for r in rows.select("model").distinct().collect()})
        return rows

    handle = st.latest_model_stream(out, "seq", lambda: spark.read.parquet(folder), score)
    publish(3, 7)
    handle(spark.range(0, 10).withColumnRenamed("id", "seq"), 0)
    publish(12, 15, 40)
    handle(spark.range(10, 20).withColumnRenamed("id", "seq"), 1)
    handle(spark.range(20, 30).withColumnRenamed("id", "seq"), 2)
    handle(spark.range(0).withColumnRenamed("id", "seq"), 3)
    got = {r["seq"]: r["model"] for r in spark.read.parquet(out).collect()}
    newest = lambda s: max((p * 10 for p in (3, 7, 12, 15) if p <= s), default=None)
    assert got == {s: newest(s) for s in range(30)}
    assert read == [{None, 30, 70}, {70, 120, 150}, {150}, set()]


def test_confusion_stream_equals_batch(spark):
    df = spark.range(50).select(
        F.col("id").alias("seq"), (F.col("id") % 3).cast("int").alias("a"), (F.col("id") % 2).cast("int").alias("p")
    )
    out = scratch_path(spark, "confusion")

    def consume(stream, checkpoint):
        totals = st.confusion_stream(stream, F.col("a"), F.col("p"))
        drain_batches(totals, lambda b, _: b.write.mode("overwrite").parquet(out), checkpoint, "complete")

    replay(spark, df, "seq", [20], consume)
    got = {(r["actual"], r["pred"]): r["n"] for r in spark.read.parquet(out).collect()}
    want = metrics.confusion_matrix(df, F.col("a"), F.col("p"), 3).filter("n > 0").collect()
    assert got == {(r["actual"], r["pred"]): r["n"] for r in want}


def test_csv_stream_and_named_outputs(spark, tmp_path):
    src = tmp_path / "in"
    spark.range(30).selectExpr("id", "id % 2 AS odd").write.csv(str(src))
    stream = tables.stream_csv(spark, str(src), "id long, odd int", files_per_trigger=2)
    marked = sinks.tagged(stream, {"odd": F.col("odd") == 1})
    out = scratch_path(spark, "named")
    drain_batches(marked, lambda b, i: write_named(b, i, out), scratch_path(spark, "ck"))
    back = spark.read.parquet(out)
    assert sinks.output(back, "main").count() == 30 and sinks.output(back, "odd").count() == 15


def test_end_of_input_closes_every_window(spark):
    df, out = timed(spark), scratch_path(spark, "closed")
    aggs = [F.count("*").alias("n")]

    def consume(stream, checkpoint):
        drain(st.windowed(stream, "ts", "10 seconds", aggs, "4 seconds", "7 seconds"), out, checkpoint)

    replay(spark, df, "seq", [20, 41], consume, end_of_input(df, "ts", 17))
    got = {r["s"]: r["n"] for r in spark.read.parquet(out).selectExpr("unix_seconds(window.start) AS s", "n").collect()}
    want: dict[int, int] = {}
    for t in range(0, 120, 2):
        for s in range(t // 4 * 4, t - 10, -4):
            want[s] = want.get(s, 0) + 1
    assert got == want
    empty = end_of_input(df.limit(0), "ts", 17)
    assert [r["ts"] for r in empty.collect()] == [None]


def test_counts_of_a_stream_stay_whole(spark):
    out, state = scratch_path(spark, "large"), scratch_path(spark, "large-state")
    handle = st.running_sums(spark, out, state, "seq", {"total": F.lit(2**53 + 1)}, kind="bigint")
    replay(spark, timed(spark, 4), "seq", [2], lambda stream, c: drain_batches(stream, handle, c))
    got = sorted(r["total"] for r in spark.read.parquet(out).collect())
    assert got == [k * (2**53 + 1) for k in (1, 2, 3, 4)]

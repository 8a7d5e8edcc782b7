"""Cases in which rows, signs or scores were once lost or bent."""

import pathlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import common, licenses, neighbours, ordinal, private, quality, sharding, substrings
from millrace.runtime import shared_dir

PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def test_two_texts_of_one_doc_id_both_stay(spark):
    texts = ["the quick brown fox jumps over the lazy dog near the old river bank today", "completely other words about sharing bread and salt with kind neighbours tonight"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[0]), (None, texts[1]), (None, texts[0] + " again"), (None, "x y z"), (None, "x y z")]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], PLAIN)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()), key=str)
    one = [t for d, t in got if d == 1]
    assert sorted(one) == sorted(texts) and not any(d == 2 for d, _ in got)
    assert [t for d, t in got if d is None and t == "x y z"] == ["x y z"]


def test_shapes_read_the_whole_token():
    assert private.shape("-" * 64 + "4111") == "-+9999"
    assert private.shape("ab12-345678901") == "a99-9+"
    long = "".join(f"a{'-' * (1 + i % 5)}" for i in range(60))
    assert private.shape(long + "1") != private.shape(long + "@") and len(private.shape(long + "1")) < 80


def test_word_forms_read_the_whole_word():
    assert ordinal.word_features("1" * 41 + "x") != ordinal.word_features("1" * 41 + "-")


def test_one_row_of_a_doc_id_in_the_fit(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "good words")] * 300 + [(2, "bad words"), (3, None)], "doc_id long, text string")
    ratings = spark.createDataFrame([(1, 2), (2, 0), (3, 1), (1, 2)], "doc_id long, grade int")
    rated = ordinal.fit_on(docs, ratings)
    assert np.array_equal(rated, ordinal.fit_on(docs.distinct(), ratings))
    one_grade = spark.createDataFrame([(1, 2), (2, 2)], "doc_id long, grade int")
    assert np.isfinite(ordinal.fit_on(docs, one_grade)).all()
    assert np.isfinite(ordinal.fit_on(docs, one_grade.limit(0))).all()


@pytest.mark.parametrize("wrap", [None, 9, 1000])
def test_scattered_words_are_no_licence(wrap):
    words = ["filler"] * 5000
    for at, w in zip(range(0, 5000, 1000), ["licensed", "under", "cc", "by"]):
        words[at] = w
    index = licenses.Index({}, licenses.THRESHOLD)
    cut = words if wrap is None else [x + ("\n" if i % wrap == wrap - 1 else "") for i, x in enumerate(words)]
    assert licenses.scan(" ".join(cut), index)[5:] == ("", 0.0)


def test_line_breaks_change_nothing():
    rng = np.random.default_rng(4)
    index = licenses.Index({}, licenses.THRESHOLD)
    for label, text in licenses.TEMPLATES:
        words = text.split()
        some = [w for w in words for _ in range(1 + (rng.random() < 0.1))]
        line = " ".join(["before"] * 30 + some + ["after"] * 30)
        want = licenses.scan(line, index)
        assert label in want[5].split(",")
        for every in (3, 7, 20):
            parts = line.split(" ")
            wrapped = "\n".join(" ".join(parts[i : i + every]) for i in range(0, len(parts), every))
            assert licenses.scan(wrapped, index) == want


def test_tiny_and_huge_vectors(spark):
    base = np.random.default_rng(2).normal(size=(6, 4))
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(base, [1e-200, 1e200, 1.0, 1e-300, 1e300, 1e-200]))]
    got = neighbours.nearest(spark.createDataFrame(rows, "id long, vector array<double>"), F.col("id") >= 0, 5).toPandas()
    assert len(got) == 30 and np.isfinite(got["score"]).all()
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    for r in got.itertuples():
        assert abs(r.score - unit[r.query_id] @ unit[r.id]) < 1e-12


def test_repeated_ids_take_their_first_vector(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.5, 0.5]), (2, [0.0, 2.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "id long, vector array<double>"), F.col("id") == 2, 5).collect()
    assert [(r["id"], r["score"]) for r in got] == [(1, 1.0)]


def test_propagation_goes_on_until_nothing_moves(spark):
    """Groups end on one shard each where there is room."""
    rng = np.random.default_rng(3)
    cells = [(g, g, int(h), int(h), int(rng.integers(1, 9))) for g in range(40) for h in rng.choice(16, 5, replace=False)]
    frame = spark.createDataFrame(cells, "group long, group_two long, home int, shard int, n long")
    before = frame.groupBy("group", "shard").agg(F.sum("n").alias("n")).groupBy("group").count().agg(F.sum(F.col("count") - 1)).first()[0]
    out = sharding.propagate(frame, 10_000, 16).toPandas()
    assert out["n"].sum() == sum(c[-1] for c in cells)
    assert (out.groupby("group")["shard"].nunique() == 1).all() and before == 160
    tight = sharding.propagate(frame, -(-int(out["n"].sum()) // 16), 16).toPandas()
    assert tight["n"].sum() == out["n"].sum()
    assert (tight.groupby("group")["shard"].nunique() - 1).sum() < before / 2


def test_cut_of_a_whole_table_falls(spark):
    """Links between shards, against the shards that the hash alone gives."""
    docs = spark.createDataFrame([(i, f"text {i // 3}" if i < 900 else "copy" if i < 1400 else None) for i in range(1500)], "doc_id long, text string")
    got = sharding.shard_documents(docs).toPandas().merge(docs.toPandas(), on="doc_id")
    got["text"] = got["text"].fillna("")
    assert got["shard"].value_counts().agg(["min", "max"]).tolist() == [93, 94]
    parts = got.groupby("text")["shard"].nunique()
    start = sharding.described(docs).withColumn("home", F.pmod(F.xxhash64("doc_id"), F.lit(16))).groupBy("group").agg(F.countDistinct("home").alias("n"))
    assert (parts - 1).sum() < 0.2 * (start.agg(F.sum(F.col("n") - 1)).first()[0])


def test_a_text_that_fills_everything_is_numbered_in_small_blocks(spark):
    rows = spark.range(60_000).select("id", F.lit(1).alias("g"), F.when(F.col("id") % 3 == 0, F.xxhash64("id")).otherwise(F.lit(77).cast("long")).alias("o"))
    rows = rows.withColumn("t", F.xxhash64("id"))
    out = common.numbered(rows, ["g"], F.col("o"), F.col("t"), per_block=100)
    assert sorted(out.toPandas()["number"]) == list(range(60_000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "_deep" in plan


def test_quality_carries_columns_of_any_name(spark):
    names = ["_lang", "_max_symbols", "_words", "_at", "_c0", "kept", "_level"]
    text = "a fine long line of many different words that tells something new to everybody here"
    docs = spark.createDataFrame([(i, text + f" {i}", "en", "a", *[i] * len(names)) for i in range(20)], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in names))
    got = quality.quality_rules(docs, keep_text=True).toPandas()
    assert got["kept"].all() and got["kept"].dtype == bool
    for n in names:
        if n != "kept":
            assert got[n].tolist() == got["doc_id"].tolist()
    bare = quality.quality_rules(docs.select("text", "doc_id")).toPandas()
    assert "text" not in bare and len(bare) == 20


def test_batches_of_null_ids_are_dealt_by_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BATCH_CHARS", 2000)
    shared = " ".join(f"w{i}" for i in range(40))
    rows = [(None, f"{shared} tail{i}") for i in range(30)] + [(None, " ".join(f"u{k}x{i}" for k in range(40))) for i in range(30)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert sorted(got["n_removed"]) == [0] * 30 + [40] * 30
    assert isinstance(got, pd.DataFrame) and len(got) == 60


def stored_by(spark, stage, docs) -> dict:
    """Names of the folders that a stage stores, and their columns."""
    shared = pathlib.Path(shared_dir(spark))
    before = set(shared.iterdir())
    stage(spark, docs, "").write.format("noop").mode("overwrite").save()
    made = [p for p in set(shared.iterdir()) - before if any(p.glob("part-*"))]
    return {p: spark.read.parquet(str(p)).columns for p in made}


@pytest.mark.parametrize("stage", [corpus_pipeline.quality_stage, corpus_pipeline.near_duplicate_stage])
def test_stages_that_choose_rows_store_no_text_again(spark, stage):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = stored_by(spark, stage, docs)
    assert made and not [p for p, columns in made.items() if "text" in columns]


def test_texts_are_stored_small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = [p for p, columns in stored_by(spark, corpus_pipeline.substring_stage, docs).items() if "text" in columns]
    assert made and all(list(p.glob("part-*")) == list(p.glob("*.zstd.parquet")) for p in made)


def test_rows_are_told_apart_wherever_they_come_from(spark):
    same = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(1, same), (2, same), (None, same), (3, "other words"), (3, "other words"), (None, "x y z"), (None, "x y z")]
    docs = spark.createDataFrame([(d, t, "en", "a", k) for k, (d, t) in enumerate(rows)], PLAIN)
    stored = corpus_pipeline.materialise(docs.repartition(4), "told-apart")
    doubled = stored.crossJoin(spark.range(2).select("id")).drop("id")  # two rows of one place
    for given in (docs, stored, stored.where("n_chars >= 0"), doubled, stored.union(stored)):
        got = corpus_pipeline.near_duplicate_stage(spark, given, "").collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == [(1, same), (3, "other words"), (None, "x y z")]

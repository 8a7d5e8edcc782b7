import pytest
from pyspark.sql import functions as F

from millrace.functions import features as fx
from millrace.functions.constants import CARRIERS, METHANE_NORMS, METHANE_WINDOW_NORMS
from millrace.functions.spec import Feature, FeatureSpec, learn_vocabulary
from millrace.plans import presets
from millrace.sources import sinks, tables


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_levels_golden(spark):
    df = spark.createDataFrame([(x,) for x in (0.99, 1.0, 1.49, 1.5)], "x double")
    got = [r["l"] for r in df.select("x", fx.bin_levels(F.col("x"), 1.0, 1.5).alias("l")).orderBy("x").collect()]
    assert got == [0, 1, 1, 2]
    assert one(spark, fx.bin_levels(F.lit(None).cast("double"), 1.0, 1.5)) is None


def test_one_hot_unknown_and_null(spark):
    assert one(spark, fx.one_hot(F.lit("b"), ["a", "b"])) == [0.0, 1.0]
    assert one(spark, fx.one_hot(F.lit("z"), ["a", "b"])) == [0.0, 0.0]
    assert one(spark, fx.one_hot(F.lit(None).cast("string"), ["a", "b"])) == [0.0, 0.0]
    assert one(spark, fx.one_hot_ordinal(F.lit(9), 3)) == [0.0, 0.0, 0.0]
    assert one(spark, fx.ordinal_out_of_range(F.lit(9), 3)) is True


def test_expand_slot_first_middle_last(spark):
    vec = F.array(*[F.lit(float(x)) for x in (7, 1, 9)])
    assert one(spark, fx.expand_slot(vec, 1, 3)) == [7, 0, 1, 0, 9]
    last = F.array(*[F.lit(float(x)) for x in (7, 9, 2)])
    assert one(spark, fx.expand_slot(last, 2, 3)) == [7, 9, 0, 0, 1]
    first = F.array(*[F.lit(float(x)) for x in (0, 5)])
    assert one(spark, fx.expand_slot(first, 0, 2)) == [1, 0, 5]


def test_pad_refuses_a_vector_that_is_too_wide(spark):
    vec = F.array(F.lit(1.0), F.lit(2.0))
    assert one(spark, fx.pad(vec, 4)) == [1, 2, 0, 0]
    with pytest.raises(Exception, match="wider"):
        one(spark, fx.pad(vec, 1))


def test_arg_max_takes_the_first_on_ties(spark):
    assert one(spark, fx.arg_max(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))) == 1


def test_rejected_rows_are_reported_not_lost(spark):
    df = spark.createDataFrame([("1", "'2'"), ("x", "3"), (None, "y")], "a string, b string")
    good, bad = fx.split_rejected(df, ["a", "b"])
    assert [tuple(r) for r in good.collect()] == [(1.0, 2.0)]
    assert sorted(r["bad_cells"] for r in bad.collect()) == [1, 2]


def test_event_time(spark):
    t = fx.event_time(*[F.lit(float(x)) for x in (2014, 3, 2, 23, 59, 58)])
    assert one(spark, F.unix_seconds(t)) == 1393804798


def test_fixed_values():
    assert len(CARRIERS) == 30 and len(METHANE_NORMS) == len(METHANE_WINDOW_NORMS) == 34


def test_spec_width_is_checked():
    with pytest.raises(ValueError):
        FeatureSpec(("a",), (Feature("a", "ordinal", size=7),), width=3)


def test_presets_have_the_documented_widths(spark):
    assert presets.game_outcome().coded_width() == 116
    assert presets.forest_cover().coded_width() == 54
    assert len(presets.forest_cover().nominal_slots()) == 44
    assert presets.methane_linear().coded_width() == 34
    assert presets.methane_network().coded_width() == 28
    assert presets.weather().coded_width() == 135
    names = ["delay", "a", "b", "dow", "c", "d", "carrier", "origin", "dest"]
    spec = presets.airline_delay(names, ["ABE", "BOS"], ["BOS"])
    assert spec.coded_width() == 4 + 7 + 30 + 2 + 1 and spec.width == 780


def test_airline_row(spark):
    names = ["delay", "a", "b", "dow", "c", "d", "carrier", "origin", "dest"]
    spec = presets.airline_delay(names, ["ABE", "BOS"], ["BOS"])
    row = [(15.0, 1.0, 2.0, 3.0, 4.0, 5.0, "'AA'", "'BOS'", "'XXX'")]
    out = spec.apply(spark.createDataFrame(row, spec.schema()), keep=[]).first()
    f = list(out["features"])
    assert out["label"] == 0 and len(f) == 780
    assert f[:2] == [1, 2] and f[2:9] == [0, 0, 1, 0, 0, 0, 0] and f[9:11] == [4, 5]
    assert f[11:41].index(1.0) == 1 and f[41:43] == [0, 1] and f[43:] == [0] * 737


def test_learned_vocabulary_refuses_to_truncate(spark):
    df = spark.createDataFrame([(x,) for x in "cab"], "w string")
    assert learn_vocabulary(df, "w") == ("a", "b", "c")
    with pytest.raises(ValueError):
        learn_vocabulary(df, "w", limit=2)


def test_line_order_follows_files_and_lines(spark, tmp_path):
    for f, lo in (("a.csv", 0), ("b.csv", 40)):
        (tmp_path / f).write_text("".join(f"{i}\n" for i in range(lo, lo + 40)))
    df = tables.line_order(tables.read_csv(spark, str(tmp_path), "v long"))
    assert all(r["seq"] == r["v"] for r in df.collect()) and df.count() == 80


def test_run_folder_uses_calendar_date():
    from datetime import datetime

    assert sinks.run_folder("/x/", datetime(2022, 11, 4, 17, 52, 47)) == "/x/output-2022-11-04_17-52-47"

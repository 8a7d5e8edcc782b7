"""Whole jobs on a headerless file: read, number, prepare, learn, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import features as fx
from millrace.functions.constants import METHANE_ALARM, METHANE_WARNING, METHANE_WINDOW_NORMS
from millrace.functions.spec import FeatureSpec
from millrace.learners.linear import linear_scan
from millrace.learners.network import Autoencoder, EncodedNetwork, Network, train_in_rounds
from millrace.learners.tree import TreeParams, prequential_hoeffding, tree_snapshots, tree_vote
from millrace.operators import connect, metrics, windows
from millrace.operators.order import Rounds, with_rank
from millrace.plans import presets
from millrace.runtime import materialise
from millrace.sources.tables import line_order, read_csv


def load(spark: SparkSession, path: str, spec: FeatureSpec, *extra: str) -> DataFrame:
    """Prepared rows with their line number as ``rank``, written once."""
    raw = line_order(read_csv(spark, path, spec.schema()), "rank")
    return materialise(spec.apply(raw, keep=["rank", *extra]), "prepared")


def tree_job(
    spark: SparkSession, path: str, spec: FeatureSpec, classes: int, every: int = 10_000,
    first: int = 1024, **options,
) -> tuple[DataFrame, DataFrame]:
    """Hoeffding tree over the whole file: predictions and accuracy every N rows."""
    params = TreeParams(
        spec.width or spec.coded_width(),
        classes,
        nominal=tuple((i, 2) for i in spec.nominal_slots()),
        **options,
    )
    rows = load(spark, path, spec)
    scored = materialise(
        prequential_hoeffding(rows, "rank", "features", "label", params, first=first), "scored"
    )
    right = F.col("pred") == F.col("label")
    return scored, metrics.accuracy_progress(scored, "rank", right, every)


def keyed_tree_job(
    spark: SparkSession, path: str, spec: FeatureSpec, classes: int, key_slot: int, warmup: int,
    first: int = 1024, **options,
) -> DataFrame:
    """One tree per value of a feature; accuracy after the warm-up of each key."""
    rows = load(spark, path, spec).withColumn("key", F.col("features")[key_slot])
    ranked = materialise(
        with_rank(rows.withColumnRenamed("rank", "line"), "line", ["key"]), "keyed"
    )
    params = TreeParams(spec.width or spec.coded_width(), classes, **options)
    scored = prequential_hoeffding(
        ranked, "rank", "features", "label", params, ["key"], ["line"], first
    )
    scored = materialise(scored.withColumn("seen", F.col("rank") + 1), "scored")
    return metrics.warmup_accuracy(
        scored, "line", F.col("pred") == F.col("label"), warmup, ["key"], seen="seen"
    )


def linear_job(
    spark: SparkSession, path: str, spec: FeatureSpec, lr: float, every: int = 100_000
) -> tuple[DataFrame, DataFrame]:
    """Delta-rule learner: predictions and running error per output."""
    rows = load(spark, path, spec)
    outputs = len(spec.targets)
    scored = materialise(
        linear_scan(rows, "rank", "features", "targets", spec.coded_width(), outputs, lr), "scored"
    )
    return scored, metrics.error_progress(scored, "rank", "actual", "pred", outputs, every)


def level_pairs(
    scored: DataFrame, warning: float = METHANE_WARNING, alarm: float = METHANE_ALARM
) -> DataFrame:
    """One row per record and output with its actual and predicted level; the
    readings are fractions, the levels are in percent."""
    long = fx.one_row_per_output(scored, "actual", "pred", ["rank"])
    out = long.select(
        "rank",
        "output",
        fx.bin_levels(F.col("actual") * 100.0, warning, alarm).alias("actual"),
        fx.bin_levels(F.col("pred") * 100.0, warning, alarm).alias("pred"),
    )
    return out.withColumn("tag", fx.output_tag(F.col("output"), F.col("actual")))


def network_job(spark: SparkSession, path: str, encode: bool = False, first: int = 1024):
    """Methane network (or autoencoder and network): predictions and the
    confusion of levels."""
    rows = load(spark, path, presets.methane_network())
    if encode:
        coder = Autoencoder(Network((28, 16, 8, 4, 8, 16, 28), lr=0.01), 3)
        model = EncodedNetwork(coder, Network((4, 4, 4, 3), lr=0.01))
    else:
        model = Network((28, 16, 16, 8, 8, 4, 3), lr=0.01)
    scored = train_in_rounds(rows, "rank", "features", "targets", model, first=first)
    pairs = level_pairs(scored)
    return scored, metrics.confusion_matrix(pairs, F.col("actual"), F.col("pred"), 3)


def window_network_job(
    spark: SparkSession, path: str, size: int = 15, slide: int = 1, first: int = 1024
) -> tuple[DataFrame, DataFrame]:
    """Sliding windows of whole records as one vector into a network that learns
    only from records it gets wrong by more than 0.1. Returns the predictions and
    the windows that had too few rows."""
    cols = presets.METHANE_COLUMNS
    spec = FeatureSpec(cols, ())
    raw = line_order(read_csv(spark, path, spec.schema()), "rank")
    scaled = fx.normalise(
        fx.vector(cols[:34]), [1.0 if i == 32 else n for i, n in enumerate(METHANE_WINDOW_NORMS)]
    )
    rows = raw.select(
        "rank",
        fx.event_time(*presets.METHANE_TIME).alias("ts"),
        fx.scale(fx.expand_slot(scaled, 32, 3), 2020.0).alias("features"),
        fx.vector(cols[34:]).alias("targets"),
    )
    full, short = windows.flatten_windows(
        materialise(rows, "prepared"), "ts", "rank", "features", "targets", size, slide, size
    )
    ordered = materialise(with_rank(materialise(full, "windows"), "window_start"), "ordered")
    net = Network((36 * size, 32, 16, 4, 3), lr=0.001, learn_above=0.1)
    scored = train_in_rounds(
        ordered, "rank", "features", "targets", net, keep=["window_start"], first=first
    )
    return scored, short


def train_test_job(
    spark: SparkSession, path: str, spec: FeatureSpec, classes: int, every: int = 1000,
    growth: float = 1.0, **options,
) -> DataFrame:
    """The same file as training and test stream: a Hoeffding tree is published
    after every ``every`` rows (with ``growth`` above 1 at growing intervals), test rows
    are judged by the newest one, accuracy per full count window."""
    rows = load(spark, path, spec)
    params = TreeParams(
        spec.width or spec.coded_width(),
        classes,
        nominal=tuple((i, 2) for i in spec.nominal_slots()),
        **options,
    )
    snaps = tree_snapshots(rows, "rank", "features", "label", params, first=Rounds(every, growth))
    judged = connect.with_latest(
        rows.select("rank", "features", "label"), "rank", {"model": snaps}, by_reference=True
    )
    right = F.coalesce(tree_vote("features", "model"), F.lit(0)) == F.col("label")
    return metrics.window_accuracy(judged, "rank", right, every)

"""Feature specifications for the public data sets this kind of stream learning
is usually shown on. Each describes a headerless comma-separated file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from millrace.functions import features as fx
from millrace.functions.constants import (
    CARRIERS,
    DELAY_GRACE_MINUTES,
    METHANE_NORMS,
)
from millrace.functions.spec import Feature, FeatureSpec


def _names(prefix: str, n: int) -> tuple[str, ...]:
    return tuple(f"{prefix}{i}" for i in range(n))


def game_outcome() -> FeatureSpec:
    """117 columns: outcome (1 = win), then cluster, mode, type and 113 more."""
    cols = ("outcome", *_names("f", 116))
    return FeatureSpec(
        cols, tuple(Feature(c) for c in cols[1:]), label=fx.equals_label(F.col("outcome"), 1)
    )


def forest_cover() -> FeatureSpec:
    """10 quantities, 44 yes/no columns, cover type 1..7."""
    cols = (*_names("q", 10), *_names("b", 44), "cover")
    feats = [Feature(c) for c in cols[:10]] + [Feature(c, "nominal") for c in cols[10:54]]
    return FeatureSpec(cols, tuple(feats), label=fx.zero_based_label(F.col("cover")))


def airline_delay(
    columns: Sequence[str], origins: Sequence[str], destinations: Sequence[str], width: int = 780
) -> FeatureSpec:
    """Departure delay first, day of week in column 3, carrier, origin and
    destination in 6 to 8, everything else numeric. The airport lists are learned
    from the data (``learn_vocabulary``) or passed in."""
    kinds = {
        3: Feature(columns[3], "ordinal", size=7),
        6: Feature(columns[6], "vocabulary", vocabulary=CARRIERS),
        7: Feature(columns[7], "vocabulary", vocabulary=tuple(origins)),
        8: Feature(columns[8], "vocabulary", vocabulary=tuple(destinations)),
    }
    feats = tuple(kinds.get(i, Feature(c)) for i, c in enumerate(columns) if i != 0)
    return FeatureSpec(
        tuple(columns),
        feats,
        label=fx.threshold_label(F.col(columns[0]), DELAY_GRACE_MINUTES),
        width=width,
        text_columns=tuple(columns[i] for i in (6, 7, 8)),
    )


METHANE_TIME = ("year", "month", "day", "hour", "minute", "second")
METHANE_COLUMNS = (*METHANE_TIME, *_names("s", 28), *_names("target", 3))


def methane_linear() -> FeatureSpec:
    """All 34 leading columns, each by its own divisor; three targets in percent."""
    feats = tuple(Feature(c, divisor=n) for c, n in zip(METHANE_COLUMNS, METHANE_NORMS))
    return FeatureSpec(METHANE_COLUMNS, feats, targets=METHANE_COLUMNS[34:], target_divisor=100.0)


def methane_network() -> FeatureSpec:
    """The 28 sensors by a thousand; three targets in percent."""
    feats = tuple(Feature(c, divisor=1000.0) for c in METHANE_COLUMNS[6:34])
    return FeatureSpec(METHANE_COLUMNS, feats, targets=METHANE_COLUMNS[34:], target_divisor=100.0)


def weather(columns: int = 137, target: int = 2, divisor: float = 60.0) -> FeatureSpec:
    """One target column, the last column ignored, every other one by ``divisor``."""
    cols = _names("c", columns)
    feats = tuple(
        Feature(c, divisor=divisor) for i, c in enumerate(cols[:-1]) if i != target
    )
    return FeatureSpec(cols, feats, targets=(cols[target],))

"""Declarative description of an input table: which columns become features,
how, and what the label or the targets are."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import features as fx


@dataclass(frozen=True)
class Feature:
    """One input column. ``kind`` is ``numeric`` (divided by ``divisor``),
    ``nominal`` (kept as a small code), ``vocabulary`` or ``ordinal`` (one-hot)."""

    column: str
    kind: str = "numeric"
    divisor: float = 1.0
    vocabulary: tuple[str, ...] = ()
    size: int = 0
    quote: str = "'"

    def width(self) -> int:
        return {"vocabulary": len(self.vocabulary), "ordinal": self.size}.get(self.kind, 1)

    def slots(self) -> Column:
        col = F.col(self.column)
        if self.kind == "numeric":
            value = col.try_cast("double")
            return F.array(value / F.lit(self.divisor) if self.divisor != 1.0 else value)
        if self.kind == "nominal":
            return F.array(col.try_cast("double"))
        if self.kind == "ordinal":
            return fx.one_hot_ordinal(col.try_cast("double").cast("int"), self.size)
        if self.kind == "vocabulary":
            return fx.one_hot(fx.unquote(col.cast("string"), self.quote), self.vocabulary)
        raise ValueError(f"unknown feature kind {self.kind!r}")


@dataclass(frozen=True)
class FeatureSpec:
    """Turns raw columns into ``features`` plus ``label`` or ``targets``.

    ``columns`` is the file layout of a headerless source. ``width`` pads the
    feature vector with zeros; a spec that needs more is refused when built.
    """

    columns: tuple[str, ...]
    features: tuple[Feature, ...]
    label: Column | None = None
    targets: tuple[str, ...] = ()
    target_divisor: float = 1.0
    width: int | None = None
    text_columns: tuple[str, ...] = field(default=())

    def __post_init__(self):
        needed = self.coded_width()
        if self.width is not None and needed > self.width:
            raise ValueError(f"features need {needed} slots, width is {self.width}")

    def coded_width(self) -> int:
        return sum(f.width() for f in self.features)

    def schema(self) -> T.StructType:
        """Layout of the headerless file; only listed text columns are strings."""
        return T.StructType(
            [
                T.StructField(c, T.StringType() if c in self.text_columns else T.DoubleType())
                for c in self.columns
            ]
        )

    def nominal_slots(self) -> tuple[int, ...]:
        """Positions in the vector that hold a code, not a quantity."""
        out, at = [], 0
        for f in self.features:
            if f.kind == "nominal":
                out.append(at)
            at += f.width()
        return tuple(out)

    def with_vocabulary(self, column: str, words: Sequence[str]) -> FeatureSpec:
        return replace(
            self,
            features=tuple(
                replace(f, kind="vocabulary", vocabulary=tuple(words)) if f.column == column else f
                for f in self.features
            ),
        )

    def vector(self) -> Column:
        plain = all(f.kind in ("numeric", "nominal") for f in self.features)
        if plain:
            vec = F.array(*[F.get(f.slots(), F.lit(0)) for f in self.features])
        else:
            vec = F.concat(*[f.slots() for f in self.features])
        return fx.pad(vec, self.width) if self.width and self.width > self.coded_width() else vec

    def apply(self, df: DataFrame, keep: Sequence[str | Column] = ("seq",)) -> DataFrame:
        out = [*keep, self.vector().alias("features")]
        if self.label is not None:
            out.append(self.label.cast("int").alias("label"))
        if self.targets:
            out.append(
                fx.scale(fx.vector(self.targets), self.target_divisor).alias("targets")
                if self.target_divisor != 1.0
                else fx.vector(self.targets).alias("targets")
            )
        return df.select(*out)


def learn_vocabulary(df: DataFrame, column: str, limit: int = 10_000) -> tuple[str, ...]:
    """Sorted distinct values of a column. The result becomes slots of a vector,
    so more than ``limit`` of them is an error rather than a truncated list."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return tuple(sorted(str(r[0]) for r in rows))

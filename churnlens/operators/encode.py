"""Encodings and feature assembly (P7-P12) and standardisation (M1).

Fit steps read only small, bounded facts (distinct levels, means, standard
deviations); transforms are pure projections that stay in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions import binarize
from churnlens.schema import SubscriberColumns
from churnlens.session import materialize


def encode_flags(df: DataFrame, columns: Sequence[str], positive: str = "Yes",
                 suffix: str = "_enc") -> DataFrame:
    """1 iff the value is ``positive`` (P7); 'no service' and null -> 0."""
    return df.withColumns({c + suffix: binarize(c, positive) for c in columns})


def encode_equals(df: DataFrame, pairs: Sequence[tuple[str, str]], suffix: str = "_enc") -> DataFrame:
    """1 iff the column equals the named value."""
    return df.withColumns({c + suffix: binarize(c, v) for c, v in pairs})


def columns_with_suffix(df: DataFrame, suffix: str = "_enc") -> list[str]:
    """Every column ending in ``suffix``, in creation order."""
    return [c for c in df.columns if c.endswith(suffix)]


@dataclass(frozen=True)
class OneHotModel:
    """Fitted levels per column; ``transform`` adds ``prefix_level`` int columns."""

    specs: tuple[tuple[str, str, tuple[str, ...]], ...]   # (column, prefix, kept levels)

    @property
    def output_columns(self) -> list[str]:
        return [f"{p}_{lv}" for _, p, levels in self.specs for lv in levels]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{p}_{lv}": F.col(c).eqNullSafe(F.lit(lv)).cast("int")
                               for c, p, levels in self.specs for lv in levels})


def fit_one_hot(df: DataFrame, columns: Sequence[tuple[str, str]], max_levels: int,
                drop_first: bool = False) -> OneHotModel:
    """Sorted distinct levels per column (P9); ``drop_first`` drops the first (P10).

    ``max_levels`` is the model width that the caller accepts per column (one
    output column per level): a column with more levels is refused, as it is
    no category.  One distributed distinct over ``(column, level)``, counted
    per column before any level is fetched.
    """
    names = [c for c, _ in columns]
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in names])
            .unpivot([], names, "variable", "level")
            .where(F.col("level").isNotNull())
            .distinct())
    long = materialize(long, "levels")
    counts = {r["variable"]: r["n"] for r in long.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in names:
        if counts.get(c, 0) > max_levels:
            raise ValueError(f"{c} has {counts[c]} levels, more than max_levels={max_levels}")
    sets = long.groupBy("variable").agg(F.sort_array(F.collect_list("level")).alias("levels"))  # max_levels at most
    levels = {r["variable"]: r["levels"] for r in sets.collect()}
    specs = []
    for c, prefix in columns:
        lv = levels.get(c, [])
        specs.append((c, prefix, tuple(lv[1:] if drop_first else lv)))
    return OneHotModel(tuple(specs))


@dataclass(frozen=True)
class StandardScalerModel:
    """Population mean/std per column; constant columns map to 0 (M1)."""

    stats: tuple[tuple[str, float, float], ...]   # (column, mean, std_pop)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = {}
        for c, mean, std in self.stats:
            x = F.col(c).cast("double") - F.lit(mean)
            out[c + suffix] = x / F.lit(std) if std and std > 0 else x * F.lit(0.0)
        return df.withColumns(out)


def fit_standard_scaler(df: DataFrame, columns: Sequence[str]) -> StandardScalerModel:
    """One aggregation for every column's mean and population std.

    ``pyspark.ml.feature.StandardScaler`` divides by the sample std; the
    reference scaled by the population std, so this fits its own.
    """
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return StandardScalerModel(tuple((c, float(row[f"m{i}"]), float(row[f"s{i}"] or 0.0))
                                     for i, c in enumerate(columns)))


@dataclass(frozen=True)
class FeatureSpec:
    """Ordered feature names plus the fitted encoders that produce them."""

    names: tuple[str, ...]
    onehot: OneHotModel
    flag_columns: tuple[str, ...]
    equal_pairs: tuple[tuple[str, str], ...]

    def transform(self, df: DataFrame) -> DataFrame:
        df = encode_flags(df, self.flag_columns)
        df = encode_equals(df, self.equal_pairs)
        return self.onehot.transform(df)


def fit_model_features(df: DataFrame, cols: SubscriberColumns) -> FeatureSpec:
    """Model features: numerics, ``_enc`` flags, one-hot with first level dropped."""
    onehot = fit_one_hot(df, cols.model_onehot, cols.max_levels, drop_first=True)
    enc = [c + "_enc" for c in cols.model_flags] + [c + "_enc" for c, _ in cols.model_equals]
    names = tuple(list(cols.numeric) + enc + onehot.output_columns)
    return FeatureSpec(names, onehot, tuple(cols.model_flags), tuple(cols.model_equals))


def fit_cluster_features(df: DataFrame, cols: SubscriberColumns) -> FeatureSpec:
    """Segmentation features: numerics, a few flags, one-hot with all levels."""
    onehot = fit_one_hot(df, cols.cluster_onehot, cols.max_levels)
    names = tuple(list(cols.numeric) + [c + "_enc" for c in cols.cluster_flags]
                  + onehot.output_columns)
    return FeatureSpec(names, onehot, tuple(cols.cluster_flags), ())

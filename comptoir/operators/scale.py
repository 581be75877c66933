"""Scaling numeric columns: fit the parameters once, apply them as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.functions.columns import as_list, numeric_columns, ref
from comptoir.operators.quantiles import quantile_columns


@dataclass(frozen=True)
class Scaler:
    """Centre and scale per column; reusable on other tables with the same columns."""

    method: str
    parameters: dict[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {c: (ref(c).cast("double") - F.lit(center)) / F.lit(scale)
                  for c, (center, scale) in self.parameters.items()}
        return df.withColumns(scaled) if scaled else df


def fit_scaler(df: DataFrame, method: str = "standard", columns: str | Sequence[str] | None = None) -> Scaler:
    """One aggregate for all columns. A column without spread keeps scale 1 and so becomes 0."""
    names = numeric_columns(df) if columns is None else as_list(columns)
    if not names:
        return Scaler(method, {})
    if method == "standard":
        pairs = {c: (F.avg(ref(c)), F.stddev_pop(ref(c))) for c in names}
    elif method == "minmax":
        pairs = {c: (F.min(ref(c)), F.max(ref(c)) - F.min(ref(c))) for c in names}
    elif method == "robust":
        quartiles = quantile_columns(df, {c: [0.25, 0.5, 0.75] for c in names})
        pairs = {c: (q[1], q[2] - q[0]) for c, q in quartiles.items()}
    else:
        raise ValueError(f"unknown scaling method: {method}")
    row = df.agg(*[
        part.cast("double").alias(f"{kind}{i}")
        for i, pair in enumerate(pairs.values()) for kind, part in zip(("center", "scale"), pair)
    ]).first()
    return Scaler(method, {c: (row[f"center{i}"], row[f"scale{i}"] or 1.0) for i, c in enumerate(pairs)})


def normalize_numeric_columns(
    df: DataFrame, method: str = "standard", columns: str | Sequence[str] | None = None
) -> DataFrame:
    return fit_scaler(df, method, columns).transform(df)

"""Imputation by median or constant."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators import sketches
from riskweave.operators.ranking import exact_quantiles


def _present(column: str) -> Column:
    return F.when(~F.isnan(column), F.col(column))


def fit_medians(
    df: DataFrame, columns: list[str], exact: bool = False, accuracy: int = 4_000
) -> dict[str, float]:
    """Median element of each double column, NULL and NaN left out: one number per column.

    The mergeable sketch needs one scan for all columns and is off the middle rank by at most one
    part in ``accuracy`` (at 99 % confidence; exact in small tables); ``exact`` takes up to three
    scans. A column without any value is absent from the result.
    """
    if exact:
        long = df.select(*columns).unpivot([], columns, "feature", "value")
        found = exact_quantiles(long, ["feature"], "value", [0.5], method="discrete")
        return {feature: values[0] for (feature,), values in found.items()}
    found = sketches.quantiles(sketches.build(df, columns, size=sketches.size_for(1 / accuracy)), [0.5]).collect()
    return {r["feature"]: r["value"] for r in found}


def impute(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Replace NULL and NaN in double columns by the given values."""
    return df.withColumns({c: F.coalesce(_present(c), F.lit(v)) for c, v in values.items()})


def impute_constant(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.fillna(values)

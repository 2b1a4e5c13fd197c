"""Set operators (U1-U3).  Each is a hash aggregate with a partial (map-side) step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of a projection (whole row when ``cols`` is None)."""
    return (df.select(*cols) if cols else df).distinct()


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Whole-row (or key) de-duplication; array / struct columns are allowed.
    With a subset, which duplicate survives is arbitrary, as in Spark."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct ids of a column."""
    return df.select(col).distinct()

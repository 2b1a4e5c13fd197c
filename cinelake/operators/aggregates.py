"""Aggregations (A1-A9).  All are hash aggregates with a map-side partial step, so a
hot group is pre-reduced in every task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, by: Sequence[str], out_col: str = "count") -> DataFrame:
    """A1: rows per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(out_col))


def row_count(df: DataFrame, out_col: str = "n_rows") -> DataFrame:
    """A2: global row count as a one-row DataFrame (lazy; no driver action)."""
    return df.agg(F.count(F.lit(1)).alias(out_col))


def count_distinct(df: DataFrame, col: str, out_col: str = "n_distinct", approx: bool = False) -> DataFrame:
    """A3: distinct non-null values of one column (approx_count_distinct on request,
    for profiling very large tables with bounded memory)."""
    agg = F.approx_count_distinct(col) if approx else F.count_distinct(F.col(col))
    return df.agg(agg.alias(out_col))


def count_distinct_tuple(df: DataFrame, cols: Sequence[str], out_col: str = "n_distinct") -> DataFrame:
    """A4: distinct tuples, null tuples included (multi-column countDistinct would
    skip any tuple holding a null)."""
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias(out_col))


def group_count_distinct(df: DataFrame, by: Sequence[str], col: str, out_col: str = "n_distinct") -> DataFrame:
    """A5: distinct values of ``col`` per group (distinct pairs, then count)."""
    return df.groupBy(*by).agg(F.count_distinct(F.col(col)).alias(out_col))


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over pairwise-complete rows; null (not an ANSI error)
    when either side has zero variance.  A row with a null on one side counts on neither."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def fit_line(
    df: DataFrame, x: str, y: str, group_by: Sequence[str] = (), digits: int = 6, extra: Sequence[Column] = ()
) -> DataFrame:
    """A7 + A8: correlation and least-squares line of y on x per group:
    corr, slope, intercept, r2, n (plus any ``extra`` aggregates, computed in the
    same pass).  Rows with a null in x or y are excluded."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.groupBy(*group_by).agg(
        *extra,
        F.round(pearson(x, y), digits).alias("corr"),
        F.round(F.regr_slope(F.col(y), F.col(x)), digits).alias("slope"),
        F.round(F.regr_intercept(F.col(y), F.col(x)), digits).alias("intercept"),
        F.round(F.regr_r2(F.col(y), F.col(x)), digits).alias("r2"),
        F.regr_count(F.col(y), F.col(x)).alias("n"),
    )


def success_rate(df: DataFrame, found_col: str, digits: int = 2) -> DataFrame:
    """A9 + F13: requested, found, missing and success percent of a flag column."""
    return df.agg(
        F.count(F.lit(1)).alias("n_requested"),
        F.count_if(F.col(found_col)).alias("n_found"),
        F.count_if(~F.col(found_col)).alias("n_missing"),
        F.round(F.try_divide(F.count_if(F.col(found_col)) * F.lit(100.0), F.count(F.lit(1))), digits).alias(
            "success_pct"
        ),
    )

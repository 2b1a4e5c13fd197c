"""Row filters (P5-P10, P13, P15, F4).  All are plain Catalyst predicates, so they
combine, push into Parquet / CSV scans, and prune columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions.text import has_any_tag, like_any, sentinel_to_null


def filter_like_any(df: DataFrame, col: str, patterns: Sequence[str]) -> DataFrame:
    """P5: keep rows whose text matches any LIKE pattern (substring semantics)."""
    return df.filter(like_any(col, patterns))


def filter_tag_token(df: DataFrame, col: str, tags: Sequence[str], sep: str = ",") -> DataFrame:
    """Keep rows whose delimited tag list holds one of the exact tokens.

    Holding a token implies containing its text, so a redundant ``contains`` test
    is added in front: it changes no result, but unlike the split / overlap test it
    reaches the Parquet reader, where a low-cardinality tag column lets whole row
    groups be skipped."""
    if not tags:
        return df.filter(F.lit(False))
    might = F.col(col).contains(tags[0])
    for t in tags[1:]:
        might = might | F.col(col).contains(t)
    return df.filter(might & has_any_tag(col, tags, sep))


def dropna_any(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or any listed) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def filter_min(df: DataFrame, col: str, minimum) -> DataFrame:
    """Minimum-sample rule, keep rows with col >= minimum (null drops)."""
    return df.filter(F.col(col) >= F.lit(minimum))


def filter_nonzero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero means unknown: keep rows where every listed column is non-zero.
    Null compares to null and is dropped as well."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) != F.lit(0))
    return df.filter(cond)


def replace_sentinel(df: DataFrame, col: str, sentinel: str = "\\N") -> DataFrame:
    """P10: sentinel text to null, row kept.  Run after dropna_any, else the rows
    that carried the sentinel would be dropped."""
    return df.withColumn(col, sentinel_to_null(col, sentinel))


def search_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Text search on a name or title."""
    return df.filter(F.col(col).like(pattern))


def filter_isin(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """membership in a literal list (pushed to Parquet as an In filter)."""
    return df.filter(F.col(col).isin(list(values)))


def filter_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Any boolean combination of Column predicates (&, |, ~, ==, !=, >=)."""
    return df.filter(predicate)

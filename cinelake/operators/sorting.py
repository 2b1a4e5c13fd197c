"""Sorts and limits (O1-O5).  A limit is only used where it is the feature (top-k,
request cap); ``orderBy + limit`` plans as TakeOrderedAndProject (per-task top-k then
a merge of k rows per task), never a full sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_asc(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """O1: ascending, nulls first (range-partitioned global sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in by])


def sort_desc(df: DataFrame, by: str, tie_break: Sequence[str]) -> DataFrame:
    """O2: descending on a measure with an ascending unique tie-break."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie_break])


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First k rows by an ordering (names sort ascending; pass Columns such as
    ``F.col(x).desc()`` for other directions; end with a unique tie-break)."""
    cols = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    return df.orderBy(*cols).limit(k)


def capped(df: DataFrame, id_col: str, cap: int) -> DataFrame:
    """Request cap, made deterministic (lowest ``cap`` ids instead of set order)."""
    return df.orderBy(F.col(id_col).asc_nulls_first()).limit(cap)

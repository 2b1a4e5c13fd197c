"""Projection operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop named columns (unknown names are ignored, as DataFrame.drop)."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns in one projection."""
    return df.withColumnsRenamed(dict(mapping))


def project_alias(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Projection with output names: {output_name: source column or expression}."""
    cols = [(F.col(src) if isinstance(src, str) else src).alias(out) for out, src in mapping.items()]
    return df.select(*cols)


def reorder_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Put the named columns first (in the given order), the rest after, by name
    (the reference uses positional slices, which break when a column moves)."""
    rest = [c for c in df.columns if c not in set(first)]
    return df.select(*first, *rest)


def add_literal(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """Constant column (for example an extraction date)."""
    lit = F.lit(value)
    return df.withColumn(name, lit.cast(dtype) if dtype else lit)

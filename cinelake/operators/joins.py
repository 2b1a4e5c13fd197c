"""Join operators.

No join carries a hint: a broadcast is the planner's choice, from file statistics or from the
size that AQE has measured, against ``spark.sql.autoBroadcastJoinThreshold``.  Above that
the join shuffles, and AQE splits the partitions of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join on differently named keys; unmatched rows of both sides
    drop.  Left as a plain join so Catalyst / AQE choose the strategy from sizes."""
    return left.join(right, left[left_key] == right[right_key], "inner")


def lookup_key(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, dim_id: str = "id", out_col: str = "id_key") -> DataFrame:
    """Replace a natural key by the dimension's surrogate id (inner, so rows
    whose key has no dimension row, including null keys, drop).  Only the id and the
    match column of the dimension are read (column pruning).  A hot key on the fact side
    is split by AQE's skew-join handling (the dimension side holds one row per key)."""
    slim = dim.select(F.col(dim_col).alias("__dim_key"), F.col(dim_id).alias(out_col))
    return fact.join(slim, fact[fact_col] == slim["__dim_key"], "inner").drop("__dim_key")


def left_lookup(fact: DataFrame, dim: DataFrame, fact_col: str, dim_key: str = "id", prefix_conflicts: str | None = None) -> DataFrame:
    """Left join of the fact to one dimension, dropping the dimension key.
    Dimension columns that already exist in the fact are renamed with ``prefix_conflicts``
    (pandas would silently suffix them _x / _y)."""
    existing = set(fact.columns)
    cols = []
    for c in dim.columns:
        if c == dim_key:
            cols.append(F.col(c).alias("__dim_key"))
        elif c in existing:
            if not prefix_conflicts:
                raise ValueError(f"column {c!r} exists on both sides; give prefix_conflicts")
            cols.append(F.col(c).alias(f"{prefix_conflicts}{c}"))
        else:
            cols.append(F.col(c))
    slim = dim.select(*cols)
    return fact.join(slim, fact[fact_col] == slim["__dim_key"], "left").drop("__dim_key")


def _distinct_keys(details: DataFrame, details_col: str) -> DataFrame:
    # de-duplicated first: the partial (map-side) aggregate collapses a key that many
    # detail records share, so no join task receives all copies of a hot key (AQE
    # can split only the left side of a semi / anti join)
    return details.select(F.col(details_col).alias("__k")).distinct()


def ids_found(ids: DataFrame, details: DataFrame, id_col: str, details_col: str) -> DataFrame:
    """Ids that have details (EXISTS, no duplication from the details side)."""
    return ids.join(_distinct_keys(details, details_col), ids[id_col] == F.col("__k"), "left_semi")


def ids_missing(ids: DataFrame, details: DataFrame, id_col: str, details_col: str) -> DataFrame:
    """Ids without details (NOT EXISTS), the error list."""
    return ids.join(_distinct_keys(details, details_col), ids[id_col] == F.col("__k"), "left_anti")

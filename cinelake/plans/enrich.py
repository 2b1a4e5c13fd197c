"""Enrichment bookkeeping (Q4, A9, W4, W5, O5) re-aimed as joins.

The reference asks a web service for each candidate id in batches of 50 and keeps
the replies plus an error list.  On Spark the replies are a landed table, so "which
ids got details" is a semi join, "which did not" an anti join, and the success rate
an aggregate over a left join.  The HTTP client itself is not built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.operators.aggregates import success_rate
from cinelake.operators.windows import batch_assign, surrogate_key

BATCH_SIZE = 50  # fixed value: ids per request batch


def mark_found(candidates: DataFrame, details: DataFrame, id_col: str, details_key: str) -> DataFrame:
    """Each candidate id with a ``found`` flag (left join to the distinct detail keys,
    so duplicated detail records never duplicate a candidate)."""
    keys = details.select(F.col(details_key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    joined = candidates.join(keys, candidates[id_col] == F.col("__k"), "left")
    return joined.select(*[candidates[c] for c in candidates.columns], F.coalesce(F.col("__hit"), F.lit(False)).alias("found"))


def enrichment_rate(candidates: DataFrame, details: DataFrame, id_col: str, details_key: str) -> DataFrame:
    """Requested, found, missing, success percent (2 decimals).  The denominator
    is the number of ids sent (the reference divides by the requested cap)."""
    return success_rate(mark_found(candidates, details, id_col, details_key), "found")


def request_batches(candidates: DataFrame, id_col: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Number candidate ids 1..n by id (W1) and cut them into fixed batches."""
    numbered = surrogate_key(candidates, [id_col], "rn")
    return batch_assign(numbered, "rn", batch_size)

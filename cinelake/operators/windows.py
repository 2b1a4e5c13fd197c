"""Window-style operators.

W1 is the one with real scale concerns.  ``row_number() over (order by ...)`` with no
partition moves every row into one task.  ``surrogate_key`` instead range-partitions and
sorts the rows by the natural key once and writes them with their place (partition and row
in it) to the shared folder; the rows per partition, one number for each, add up to offsets
that are joined back.  There is one path for every size, no boundary goes through the driver,
and re-reading the written places gives the same ids whatever task is lost.

The result equals the global ``row_number() over (order by key)`` exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.session import materialize_counted


def _order_cols(order_by: Sequence[str | Column], descending: bool = False) -> list[Column]:
    out = []
    for c in order_by:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if descending else col.asc_nulls_first())
    return out


def surrogate_key(df: DataFrame, order_by: Sequence[str], id_col: str = "id") -> DataFrame:
    """Dense 1..n ids (bigint) in natural-key order, stable across plans and
    shuffle-partition counts.  ``order_by`` must identify rows (a natural key)."""
    return surrogate_key_counted(df, order_by, id_col)[0]


def surrogate_key_counted(df: DataFrame, order_by: Sequence[str], id_col: str = "id") -> tuple[DataFrame, int]:
    """``surrogate_key`` plus the number of rows, observed while they are written."""
    by = _order_cols(order_by)
    return number_in_order(df.repartitionByRange(*by).sortWithinPartitions(*by), id_col)


def number_in_order(ordered: DataFrame, id_col: str = "id") -> tuple[DataFrame, int]:
    """Rows numbered 1..n as they stand in a sorted DataFrame (partition by partition), and
    n.  Written once with their places, so the numbers hold whatever is recomputed later."""
    # the place is partition number << 33 | row in the partition
    placed, n_rows = materialize_counted(ordered.withColumn("__place", F.monotonically_increasing_id()), "numbered")
    sizes = placed.groupBy(F.shiftright("__place", 33).alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition of the write, so never more than the shuffle has partitions
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    offsets = F.broadcast(sizes.select("__part", before.alias("__before")))
    row = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    numbered = placed.join(offsets, F.shiftright("__place", 33) == F.col("__part"))
    return numbered.select((F.col("__before") + row).cast("long").alias(id_col), *ordered.columns), n_rows


def share_of_total(df: DataFrame, measure: str, group_by: Sequence[str], out_col: str = "share_pct", scale: int = 2) -> DataFrame:
    """Value / sum(value) over its group, in percent.  Meant for aggregated input
    (one row per group x category), so the window partitions stay tiny."""
    total = F.sum(measure).over(Window.partitionBy(*group_by))
    return df.withColumn(out_col, F.round(F.try_divide(F.col(measure) * F.lit(100.0), total), scale))


def top_n_per_group(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], n: int, descending: bool = True, rank_col: str = "rank"
) -> DataFrame:
    """First n rows per group by the ordering (last key should be a unique
    tie-break).  Catalyst adds a partial WindowGroupLimit before the shuffle, so a
    hot group sends at most n rows per map task."""
    w = Window.partitionBy(*group_by).orderBy(*_order_cols(order_by[:1], descending), *_order_cols(order_by[1:]))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def batch_assign(df: DataFrame, rn_col: str, batch_size: int, out_col: str = "batch") -> DataFrame:
    """Fixed-size batches on a 1-based row number: floor((rn - 1) / size) + 1."""
    return df.withColumn(out_col, (F.floor((F.col(rn_col) - 1) / F.lit(batch_size)) + 1).cast("long"))


def balanced_split(df: DataFrame, rn_col: str, n_parts: int, out_col: str = "part", total: int | None = None) -> DataFrame:
    """Split rows numbered 1..N into n_parts parts whose sizes differ by at most
    one, the first N mod n parts one larger (ntile / array_split rule).  N is the
    caller's known count (e.g. from ``surrogate_key_counted``) or else one scalar
    subquery bound to a column, so no single-partition window and no driver loop."""
    if total is None:
        df = df.withColumn("__n", df.agg(F.count(F.lit(1))).scalar())
        n = F.col("__n")
    else:
        n = F.lit(total)
    q = F.floor(n / F.lit(n_parts))
    r = n - q * F.lit(n_parts)
    big = (q + 1) * r
    rn = F.col(rn_col)
    part = F.when(rn <= big, F.ceil(rn / (q + 1))).otherwise(r + F.ceil((rn - big) / q))
    return df.withColumn(out_col, part.cast("long")).drop("__n")

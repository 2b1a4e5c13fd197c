"""Data-quality operators (V1-V6) and the column profile.

Checks return DataFrames of offenders or counts (lazy), so they run as ordinary
distributed aggregates and can be written, joined, or asserted on by the caller.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stage_counts(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """V1: one row per named stage with its row count (stage_no, stage, n_rows).
    Each stage is a lazy aggregate; the union runs them in one job."""
    out = None
    for i, (name, df) in enumerate(stages, start=1):
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), "n_rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


class Funnel:
    """V1 without a second scan: ``funnel(name, df)`` counts a stage's rows while a later action
    runs, and ``rows`` gives (stage_no, stage, n_rows) after it.  A filter is not pushed below a counted
    stage, so only runs that want the report pay for it."""

    def __init__(self) -> None:
        self._stages: list[tuple[str, Observation]] = []

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"{name}-{uuid.uuid4().hex[:12]}")
        self._stages.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"))

    def rows(self, spark: SparkSession) -> DataFrame:
        found = [(i, name, int(seen.get["n_rows"])) for i, (name, seen) in enumerate(self._stages, start=1)]
        return spark.createDataFrame(found, "stage_no int, stage string, n_rows long")


def key_consistency(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """V2: keys that carry more than one attribute tuple (key, n_versions)."""
    return (
        df.select(key, *attrs)
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_versions"))
        .filter(F.col("n_versions") > 1)
    )


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V3: primary-key groups holding more than one row (keys..., n_rows)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def fk_violations(fact: DataFrame, refs: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """V4: for each (fact fk column, dimension, dimension key): fact rows whose key has
    no dimension row (null keys count as violations too).  One pass over the fact:
    each dimension's distinct keys are left-joined with a hit flag, then a single
    aggregate counts the misses per reference.  Lazy: nothing runs while planning."""
    rows = fact.select(*[fk for fk, _, _ in refs])
    flags = []
    for i, (fk, dim, dim_key) in enumerate(refs):
        hit = f"__hit{i}"
        keys = dim.select(F.col(dim_key).alias(f"__k{i}")).distinct().withColumn(hit, F.lit(True))
        rows = rows.join(keys, F.col(fk) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        flags.append(F.count_if(F.col(hit).isNull()).alias(fk))
    wide = rows.agg(*flags)
    return wide.unpivot([], [fk for fk, _, _ in refs], "fk_column", "n_missing")


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V5: nulls per NOT NULL column from a single aggregate, unpivoted to
    (column_name, n_nulls)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "n_nulls")


def audit(
    fact: DataFrame,
    not_null: Sequence[str],
    refs: Sequence[tuple[str, DataFrame, str]],
    key: Sequence[str],
    reported_key: Sequence[str] = (),
) -> DataFrame:
    """V3, V4 and V5 of a fact in one pass over it: (check_name, what, n_violations, blocks).  Nulls per NOT NULL
    column, rows without a dimension row per reference, groups with more than one row of the ``key`` and, without blocking, of
    a shorter ``reported_key``.  Misses and nulls are summed map-side on the way to the key groups."""
    rows, sums, checks = fact, [], []
    for i, (fk, dim, dim_key) in enumerate(refs):
        keys = dim.select(F.col(dim_key).alias(f"__k{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
        rows = rows.join(keys, F.col(fk) == F.col(f"__k{i}"), "left")
        sums.append(F.count_if(F.col(f"__hit{i}").isNull()).alias(f"__fk{i}"))
        checks.append(("foreign key", fk, F.coalesce(F.sum(f"__fk{i}"), F.lit(0)), True))
    for i, c in enumerate(not_null):
        sums.append(F.count_if(F.col(c).isNull()).alias(f"__null{i}"))
        checks.append(("not null", c, F.coalesce(F.sum(f"__null{i}"), F.lit(0)), True))
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *sums)
    checks.append(("primary key", ",".join(key), F.count_if(F.col("__n") > 1), True))
    if reported_key:  # the key's groups, grouped once more by fewer columns
        inner = [F.sum(c).alias(c) for c in groups.columns if c.startswith(("__fk", "__null"))]
        groups = groups.groupBy(*reported_key).agg(F.sum("__n").alias("__m"), F.count_if(F.col("__n") > 1).alias("__n"), *inner)
        checks[-1] = ("primary key", ",".join(key), F.coalesce(F.sum("__n"), F.lit(0)), True)
        checks.append(("declared key", ",".join(reported_key), F.count_if(F.col("__m") > 1), False))
    wide = groups.agg(*[n.cast("long").alias(f"c{i}") for i, (_, _, n, _) in enumerate(checks)])
    found = [
        F.struct(F.lit(name).alias("check_name"), F.lit(what).alias("what"), F.col(f"c{i}").alias("n_violations"), F.lit(blocks).alias("blocks"))
        for i, (name, what, _, blocks) in enumerate(checks)
    ]
    return wide.select(F.explode(F.array(*found)).alias("c")).select("c.*")


def schema_diff(actual: T.StructType, expected: T.StructType) -> list[str]:
    """V6: human-readable differences between two schemas (names, order, types)."""
    diffs = []
    a = {f.name: f for f in actual.fields}
    e = {f.name: f for f in expected.fields}
    for name in e:
        if name not in a:
            diffs.append(f"missing column {name}")
        elif a[name].dataType != e[name].dataType:
            diffs.append(f"{name}: {a[name].dataType.simpleString()} != {e[name].dataType.simpleString()}")
    for name in a:
        if name not in e:
            diffs.append(f"unexpected column {name}")
    if not diffs and [f.name for f in actual.fields] != [f.name for f in expected.fields]:
        diffs.append("column order differs")
    return diffs


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


_TEXT = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def describe_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """One typed row per column from one aggregate pass: count, mean, sample stddev,
    min and max of numbers; count, min_text and max_text of texts, dates and flags, and of integers and decimals,
    whose min and max as doubles would lose digits beyond 2**53."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if cols is None:
        cols = [c for c, t in kinds.items() if isinstance(t, _NUMERIC + _TEXT)]
    aggs, rows = [], []
    for c in cols:
        numeric, name = isinstance(kinds[c], _NUMERIC), F.col(f"`{c}`")
        x = name.cast("double") if numeric else name.cast("string")
        parts = {"count": F.count(x)}
        for stat, fn in (("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max)):
            value = fn(x) if numeric else F.lit(None).cast("double")
            parts[stat] = F.round(value, digits) if stat in ("mean", "stddev") else value
        for stat, fn in (("min_text", F.min), ("max_text", F.max)):
            if isinstance(kinds[c], _EXACT):
                parts[stat] = fn(name).cast("string")
            else:
                parts[stat] = F.lit(None).cast("string") if numeric else fn(x)
        aggs += [v.alias(f"{len(rows)}__{k}") for k, v in parts.items()]
        rows.append(F.struct(F.lit(c).alias("column_name"), *[F.col(f"{len(rows)}__{k}").alias(k) for k in parts]))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("p")).select("p.*")

"""Sinks (S4-S10, S14).  These are the only batch functions that run actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.operators.windows import surrogate_key_counted
from cinelake.session import file_system


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    """Parquet write.  Default mode fails when the target exists.
    With partition columns and mode 'overwrite' the write uses dynamic partition
    overwrite: only the partitions present in ``df`` are replaced, which makes a
    re-run of one extraction date idempotent."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            # per write, so it holds whatever the session default is
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def rebalanced_partition_write(df: DataFrame, path: str, partition_col: str, mode: str = "errorifexists") -> None:
    """Partitioned Parquet write that clusters rows by the partition value (few files per
    folder); AQE splits a hot value over as many tasks as its measured size asks for, and
    merges small ones.  'overwrite' replaces the whole table."""
    writer = df.hint("rebalance", F.col(partition_col)).write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(partition_col).parquet(path)


def write_fact(df: DataFrame, path: str, partition_col: str = "release_year", mode: str = "errorifexists") -> None:
    """Fact sink partitioned by a low-cardinality key (release year) instead of
    one folder per film (the reference's layout makes one tiny folder per film)."""
    rebalanced_partition_write(df, path, partition_col, mode)


#: Files that one task of the balanced JSON sink writes.
FILES_PER_TASK = 1000


def write_json_balanced(df: DataFrame, path: str, order_by: Sequence[str], max_per_file: int = 100) -> int:
    """JSON lines with at most ``max_per_file`` records per file and balanced
    sizes: n = floor(N / max) + 1 files, sizes differ by at most one (the first
    N mod n are one larger), all in one folder.  Non-ASCII text is written as is.
    Returns n.  The larger and the smaller files are two writes; a task gets whole files, in
    order, and the writer starts a new one after each size."""
    numbered, total = surrogate_key_counted(df, order_by, "__rn")
    n_parts = total // max_per_file + 1
    size, larger = divmod(total, n_parts)
    mode, cut = "overwrite", larger * (size + 1)
    for first, last, records in ((0, cut, size + 1), (cut, total, size)):
        if last > first or (not total and mode == "overwrite"):
            rows = numbered.filter((F.col("__rn") > first) & (F.col("__rn") <= last))
            task = F.floor((F.col("__rn") - 1 - first) / F.lit(max(1, records) * FILES_PER_TASK))
            (
                rows.repartition(task)
                .sortWithinPartitions("__rn")
                .drop("__rn")
                .write.mode(mode)
                .option("ignoreNullFields", False)
                # the folder is marked as complete by the last write only
                .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", last == total)
                .option("maxRecordsPerFile", max(1, records))
                .json(path)
            )
            mode = "append"
    return n_parts


def write_json_capped(df: DataFrame, path: str, max_per_file: int = 100) -> None:
    """S8 without the balance requirement: Spark's own per-file record cap."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_per_file).json(path)


def write_id_list(df: DataFrame, path: str, id_col: str = "id") -> None:
    """One-column CSV of ids, no header."""
    df.select(id_col).write.mode("overwrite").option("header", False).csv(path)


def land_once(df: DataFrame, path: str, fmt: str = "csv", **options) -> bool:
    """Write to a dated landing path unless a complete landing is there (its success
    marker); what a broken write left is replaced.  Returns whether it wrote."""
    fs, marker = file_system(df.sparkSession, f"{path.rstrip('/')}/_SUCCESS")
    if fs.exists(marker):
        return False
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)
    return True


def register_tables(spark: SparkSession, root: str, tables: Sequence[str], database: str | None = None) -> list[str]:
    """Catalogue refined Parquet folders as tables for SQL users."""
    names = []
    for t in tables:
        name = f"{database}.{t}" if database else t
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{root.rstrip('/')}/{t}'")
        names.append(name)
    return names


def publish_views(spark: SparkSession, build: str, tables: Sequence[str], partitioned: Sequence[str] = (), database: str | None = None) -> list[str]:
    """S14 for builds: each table of the folder ``build`` is catalogued under a name of its own, with column statistics for
    the cost-based planner, and then the view of its plain name is replaced: a query sees the build before or
    after it, and never no table.  Tables of builds that no view shows any more are left to ``drop_unshown``."""
    prefix = f"{database}." if database else ""
    mark = build.rstrip("/").rsplit("/", 1)[1].replace("-", "_")
    for t in tables:
        name = f"{prefix}{t}__{mark}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{build.rstrip('/')}/{t}'")
        if t in partitioned:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    for t in tables:
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{t} AS SELECT * FROM {prefix}{t}__{mark}")
    return [f"{prefix}{t}" for t in tables]


def drop_unshown(spark: SparkSession, tables: Sequence[str], build: str, database: str | None = None) -> list[str]:
    """Take other builds' tables of ``publish_views`` out of the catalogue (their files stay)."""
    prefix = f"{database}." if database else ""
    mark = build.rstrip("/").rsplit("/", 1)[1].replace("-", "_")
    names = [r.tableName for r in spark.sql(f"SHOW TABLES{' IN ' + database if database else ''}").collect()]
    old = [n for n in names if any(n.startswith(f"{t}__build_") for t in tables) and not n.endswith(f"__{mark}")]
    for n in old:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{n}")
    return old

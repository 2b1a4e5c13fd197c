"""Enrichment on arrival (Q4, J8 and J9 as a stream).

Credit files and detail files land independently.  Both are streamed, keyed by the external id; the
state of an id says whether it was asked for and whether details of it came.  An id that is asked for
first waits as ``pending`` and is ``found`` when its details come, however late within the timeout; details
that come first wait in the same way.  After ``timeout`` without its counterpart an asked id is
``missing`` (the error list) and its state is freed, so state holds ids of that time only.  Time is that of
the batches: each row counts as new when its batch runs, however old its file is, so no row is ever late.

The events of all drains are an append-only table; ``status`` reduces it to one row per id, which equals the
batch job's ``mark_found`` over all files so far (as long as nothing timed out).

State is a table beside the checkpoint, a version for each micro-batch: a batch's rows and the version before are
one aggregation by id, and only the last versions are kept.  A replayed batch starts from the same version and
replaces what its earlier attempt left.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.operators.aggregates import success_rate
from cinelake.operators.filters import filter_tag_token
from cinelake.plans.trusted import DEFAULT_TAG_TOKENS
from cinelake.session import file_system, remove_path
from cinelake.sources.schemas import RAW_CREDITS_DDL, RAW_DETAILS_SCHEMA

#: How far an id has come, in this order.
STATUS = ["pending", "missing", "found"]


class WaitingIds:
    """The ids of one checkpoint: (id, asked, known, last), ``last`` the time in ms of the id's latest rows, in
    versions ``folder/<batch>`` and, when a drain's end freed ids, ``folder/<batch>-end``.  Events go to
    ``out_dir/batch=<query>-<batch>``."""

    def __init__(self, checkpoint_dir: str, out_dir: str, kind: str, timeout_ms: int):
        self.checkpoint, self.folder, self.out_dir = checkpoint_dir, f"{checkpoint_dir}/ids", out_dir
        self.schema = f"id {kind}, asked boolean, known boolean, last long, status string, kept boolean"
        self.timeout_ms = timeout_ms

    def version(self, spark: SparkSession, batch: int) -> str | None:
        """The newest whole version up to a batch."""
        fs, path = file_system(spark, self.folder)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        whole = [n.removesuffix(".whole").split("-") for n in names if n.endswith(".whole")]
        found = max(((int(n[0]), *n[1:]) for n in whole if int(n[0]) <= batch), default=None)
        return "-".join(map(str, found)) if found else None

    def read(self, spark: SparkSession, version: str | None) -> DataFrame:
        if version is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.folder}/{version}")

    def overdue(self, now: int) -> Column:
        """Whether an id's time is over; ``now`` is that of the batch before, as rows come before timeouts."""
        return F.lit(now) > F.col("last") + F.lit(self.timeout_ms)

    def write(self, rows: DataFrame, version: str) -> None:
        """A new version, and then its events."""
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{self.folder}/{version}")
        query = spark.read.schema("id string").json(f"{self.checkpoint}/metadata").first().id
        events = self.read(spark, version).filter("status is not null").select("id", "status")
        events.write.mode("overwrite").parquet(f"{self.out_dir}/batch={query}-{version}")
        fs, marker = file_system(spark, f"{self.folder}/{version}.whole")
        fs.create(marker, True).close()

    def step(self, rows: DataFrame, batch: int) -> None:
        """One micro-batch of rows (id, asked); an id's event when its status changes."""
        spark, now = rows.sparkSession, int(time.time() * 1000)
        before = self.version(spark, batch - 1)
        prior = self.read(spark, before).filter("kept").select("id", "asked", "known", "last", F.lit(False).alias("new"))
        fresh = rows.select("id", "asked", (~F.col("asked")).alias("known"), F.lit(now).cast("long").alias("last"), F.lit(True).alias("new"))
        old = ~F.col("new")
        ids = prior.unionByName(fresh).groupBy("id").agg(
            *[F.max(c).alias(c) for c in ("asked", "known", "last", "new")],
            *[F.max(F.when(old, F.col(c))).alias(f"was_{c}") for c in ("asked", "known")],
        )
        changed = ~(F.col("asked").eqNullSafe(F.col("was_asked")) & F.col("known").eqNullSafe(F.col("was_known")))
        seen = int(before.split("-")[0]) if before else -1
        over = old & self.overdue(self.time_of(spark, seen))
        fs, marker = file_system(spark, f"{self.folder}/{batch}.time")
        out = fs.create(marker, True)
        out.writeLong(now)
        out.close()
        self.write(self._judged(ids, F.col("new") & changed, over), str(batch))
        self._forget(spark, batch - 1)

    @staticmethod
    def _judged(ids: DataFrame, changed: Column, over: Column) -> DataFrame:
        reached = F.when(F.col("asked"), F.when(F.col("known"), F.lit("found")).otherwise(F.lit("pending")))
        lost = F.when(F.col("asked") & ~F.col("known"), F.lit("missing"))
        return ids.select("id", "asked", "known", "last", F.when(over, lost).when(changed, reached).alias("status"), (~over).alias("kept"))

    def time_of(self, spark: SparkSession, batch: int) -> int:
        """When a batch ran (ms)."""
        fs, path = file_system(spark, f"{self.folder}/{batch}.time")
        if not fs.exists(path):
            return 0
        data = fs.open(path)
        try:
            return data.readLong()
        finally:
            data.close()

    def end(self, spark: SparkSession, batch: int) -> None:
        """After the drain's last batch: what its time left overdue."""
        version = self.version(spark, batch)
        if version is None or version.endswith("-end"):
            return
        ids = self.read(spark, version).filter("kept")
        over = self.overdue(self.time_of(spark, batch))
        if ids.filter(over).isEmpty():
            return
        self.write(self._judged(ids, F.lit(False), over), f"{batch}-end")

    def _forget(self, spark: SparkSession, batch: int) -> None:
        """Versions before a batch's: no replay needs them."""
        fs, path = file_system(spark, self.folder)
        for name in [s.getPath().getName() for s in fs.listStatus(path)]:
            if int(name.split(".")[0].split("-")[0]) < batch:
                remove_path(spark, f"{self.folder}/{name}")


def stream_enrichment(
    spark: SparkSession,
    credits_dir: str,
    details_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    credits_schema: T.StructType | str = RAW_CREDITS_DDL,
    details_schema: T.StructType | str = RAW_DETAILS_SCHEMA,
    id_col: str = "id",
    tag_col: str = "genero",
    tags: Sequence[str] = DEFAULT_TAG_TOKENS,
    details_key: str = "imdb_id",
    sep: str = "|",
    timeout_days: float = 30.0,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Drain what has landed in both folders; returns ``status`` of all drains so far.  Files are
    pipe-delimited credits with a header (``*.csv``) and JSON lines."""

    def source(fmt: str, schema, path: str, **options) -> DataFrame:
        reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.options(**options).load(path)

    credits = source("csv", credits_schema, credits_dir, sep=sep, header=True, pathGlobFilter="*.csv")
    asked = filter_tag_token(credits, tag_col, tags).select(F.col(id_col).alias("id"), F.lit(True).alias("asked"))
    known = source("json", details_schema, details_dir).select(F.col(details_key).alias("id"), F.lit(False).alias("asked"))
    both = asked.unionByName(known).filter("id is not null")
    kind = both.schema["id"].dataType.simpleString()
    fs, old = file_system(spark, f"{checkpoint_dir}/state")
    if fs.exists(old):
        raise ValueError(f"{checkpoint_dir} is of an earlier form of state; start with a new checkpoint and a new folder of events")
    ids = WaitingIds(checkpoint_dir, out_dir, kind, int(timeout_days * 86_400_000))
    last = []
    fs.mkdirs(file_system(spark, out_dir)[1])

    def batch(df: DataFrame, epoch_id: int) -> None:
        ids.step(df, epoch_id)
        last[:] = [epoch_id]

    query = (
        both.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if last:
        ids.end(spark, last[0])
    return status(spark.read.schema(f"id {kind}, status string").option("basePath", out_dir).parquet(out_dir).select("id", "status"))


def status(events: DataFrame) -> DataFrame:
    """(id, status): the furthest each asked id has come."""
    order = F.array_position(F.array(*[F.lit(s) for s in STATUS]), F.col("status"))
    return events.groupBy("id").agg(F.max_by("status", order).alias("status"))


def enrichment_figures(found: DataFrame) -> DataFrame:
    """A9 of a status table: requested, found, missing and success percent; waiting ids count as missing."""
    return success_rate(found.select("id", (F.col("status") == "found").alias("found")), "found")

"""Surrogate keys that stay over builds (W1 for Q5 and Q6).

``surrogate_key`` numbers a table by its natural key, so one new member in the middle renumbers all
behind it.  A ``KeyRegistry`` keeps what was given out: an anti join finds natural keys that have no
id, these are numbered on from the highest id, and a key that goes away keeps its id for when it comes
back.  Parts are written first and named in a list with one appended row, so a reader sees a part
whole or not at all.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.operators.windows import surrogate_key_counted
from cinelake.session import file_system


class KeyRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _parts(self) -> list[tuple[str, int]]:
        """(part, highest id in it), one for each build that had new keys."""
        fs, listing = file_system(self.spark, f"{self.path}/parts")
        if not fs.exists(listing):
            return []
        rows = self.spark.read.schema("part string, last long").json(f"{self.path}/parts").collect()
        return [(r.part, r.last) for r in rows]

    def ids(self) -> DataFrame | None:
        """All natural keys with their ids; None before the first."""
        parts = self._parts()
        return self.spark.read.parquet(*[f"{self.path}/{p}" for p, _ in parts]) if parts else None

    def assign(self, df: DataFrame, natural: Sequence[str], id_col: str = "id") -> DataFrame:
        """Distinct natural keys of ``df`` with their ids, old ones as they were.  Keys with a null
        get none."""
        keys = df.select(*natural).dropna().distinct()
        known = self.ids()
        new = keys if known is None else keys.join(known.select(*natural), list(natural), "left_anti")
        numbered, n = surrogate_key_counted(new, natural, "id")
        if n:
            last = max((at for _, at in self._parts()), default=0)
            part = f"keys-{uuid.uuid4().hex[:12]}"
            numbered.withColumn("id", F.col("id") + F.lit(last)).select(*natural, "id").write.parquet(f"{self.path}/{part}")
            listed = self.spark.createDataFrame([(part, last + n)], "part string, last long")
            listed.coalesce(1).write.mode("append").json(f"{self.path}/parts")
        known = self.ids()
        if known is None:
            return keys.withColumn(id_col, F.lit(None).cast("long"))
        return keys.join(known, list(natural)).withColumnRenamed("id", id_col)

"""Landing by content: a target that knows what it holds.

A checkpoint remembers files for one stream only.  Here the target itself remembers, so that a lost or
new checkpoint, a replayed batch and another trigger size all give the same rows:

    target/extraction_date=D/batch=B/      rows of one micro-batch, with each record's fingerprint
    target/_files/extraction_date=D/batch=B/   its source files: path, length, time
    target/_bits/extraction_date=D/batch=B/    a bit map of its fingerprints
    target/_commits/B                      written last: batch B is in

B comes from the batch's files, so a replay has the same B and replaces what an earlier attempt left.
Files that a committed batch holds are left out; a file that changed is landed as a new one, and its
known records are left out by their fingerprints.

A micro-batch reads the dates it holds, never the others: the file lists and bit maps of those dates, and
fingerprints only of dates in which a bit of a new record is set.  Its work grows with the batch and its
dates, not with the table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import file_system, materialize, remove_path

#: Bits of a date's map; a record sets one of them.
BITS = 1 << 26
#: Folder value of rows without a date, as Spark's writer names it.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
FILE_COLUMNS = ["source_file", "source_length", "source_time"]


def with_source_file(df: DataFrame) -> DataFrame:
    """Rows of a file source with the path, length and time of their file."""
    meta = F.col("_metadata")
    return df.select("*", *[c.alias(n) for n, c in zip(FILE_COLUMNS, (meta["file_path"], meta["file_size"], meta["file_modification_time"]))])


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def _dated(part: str, date: dt.date | None) -> str:
    return f"{part}extraction_date={date or NO_DATE}"


def _day():
    """The date as a join key that is never null."""
    return F.coalesce(F.col("extraction_date"), F.lit("0001-01-01").cast("date")).alias("__day")


class LandingTarget:
    """A table of dated rows, extended by whole batches."""

    def __init__(self, spark: SparkSession, path: str, bits: int = BITS):
        self.spark, self.path, self.bits = spark, path.rstrip("/"), bits

    # --- what is in ------------------------------------------------------------------

    def is_in(self, batch: str) -> bool:
        fs, marker = file_system(self.spark, f"{self.path}/_commits/{batch}")
        return fs.exists(marker)

    def batches(self, part: str, date: dt.date | None) -> list[str]:
        """Folders of the committed batches of one date in a part of the target."""
        folder = f"{self.path}/{_dated(part, date)}"
        found = [n.removeprefix("batch=") for n in _children(self.spark, folder) if n.startswith("batch=")]
        return [f"{folder}/batch={b}" for b in found if self.is_in(b)]

    def _read(self, part: str, dates: Sequence[dt.date], schema: str, fmt: str = "parquet") -> DataFrame:
        """Rows (with extraction_date) of those dates' committed batches."""
        folders = [f for d in dates for f in self.batches(part, d)]
        if not folders:
            return self.spark.createDataFrame([], f"{schema}, extraction_date date")
        reader = self.spark.read.schema(schema).format(fmt).option("basePath", f"{self.path}/{part}".rstrip("/"))
        got = reader.load(folders).withColumn("extraction_date", F.col("extraction_date").cast("date"))
        return got.drop("batch")

    def rows(self) -> DataFrame:
        """All rows of committed batches."""
        names = [(n,) for n in _children(self.spark, f"{self.path}/_commits") if not n.startswith((".", "_"))]
        held = self.spark.createDataFrame(names, "batch string")
        data = self.spark.read.option("basePath", self.path).parquet(self.path)
        return data.withColumn("batch", F.col("batch").cast("string")).join(F.broadcast(held), "batch", "left_semi").drop("batch", "record")

    # --- new batches -----------------------------------------------------------------

    def _place(self) -> list:
        """Bucket of the bit map, and place in it, of a record's bit."""
        bit = F.pmod(F.xxhash64("record"), F.lit(self.bits))
        return [F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("place")]

    def known_files(self, dates: Sequence[dt.date]) -> DataFrame:
        return self._read("_files/", dates, "source_file string, source_length long, source_time timestamp", "json").select(*FILE_COLUMNS)

    def unknown(self, clean: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
        """Rows of ``clean`` whose record no committed batch of their date holds."""
        maps = self._read("_bits/", dates, "bucket long, bits binary").groupBy(_day(), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        placed = clean.select(_day(), "extraction_date", "record", *self._place()).join(maps, ["__day", "bucket"])
        byte = F.conv(F.hex(F.substring("bits", (F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        maybe = placed.filter(byte.bitwiseAND(F.pow(F.lit(2), F.col("place") % 8).cast("int")) != 0)
        hit = [r.extraction_date for r in maybe.select("extraction_date").distinct().collect()]  # at most the batch's dates
        if not hit:
            return clean
        there = self._read("", hit, "record string")
        return clean.withColumn("__day", _day()).join(there.select(_day(), "record"), ["__day", "record"], "left_anti").drop("__day")

    def land(self, raw: DataFrame, clean, record_columns: Sequence[str]) -> str | None:
        """Land one batch: ``raw`` has ``extraction_date`` and FILE_COLUMNS; ``clean`` makes the
        table's rows of it and keeps the column ``record``.  Returns its name, or None if it was in."""
        raw = materialize(raw, "landing")
        one = F.xxhash64("extraction_date", *FILE_COLUMNS).cast("decimal(38,0)")
        files = raw.select("extraction_date", *FILE_COLUMNS).distinct()
        files = materialize(files, "landing-files")
        n, total = files.agg(F.count(F.lit(1)), F.sum(one)).first()
        if not n:
            return None
        batch = f"{n}x{int(total) % (1 << 64):016x}"
        if self.is_in(batch):
            return None
        dates = [r[0] for r in files.select("extraction_date").distinct().collect()]
        for part in ("", "_files/", "_bits/"):  # what an attempt without a commit left
            for d in dates:
                remove_path(self.spark, f"{self.path}/{_dated(part, d)}/batch={batch}")
        fresh = raw.join(self.known_files(dates), FILE_COLUMNS, "left_anti").drop(*FILE_COLUMNS)
        record = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in record_columns]), {"ignoreNullFields": "false"}), 256)
        rows = self.unknown(materialize(clean(fresh.withColumn("record", record)), "landing-clean"), dates)
        self._write(rows.withColumn("batch", F.lit(batch)), self.path, "parquet")
        written = self._read_own(batch, dates)
        bits = written.select("extraction_date", *self._place()).groupBy("extraction_date", "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
        self._write(bits.withColumn("batch", F.lit(batch)), f"{self.path}/_bits", "parquet")
        self._write(files.withColumn("batch", F.lit(batch)), f"{self.path}/_files", "json")
        fs, marker = file_system(self.spark, f"{self.path}/_commits/{batch}")
        fs.create(marker, True).close()
        return batch

    def _read_own(self, batch: str, dates: Sequence[dt.date]) -> DataFrame:
        """Date and record of the rows just written."""
        fs = file_system(self.spark, self.path)[0]
        folders = [f"{self.path}/{_dated('', d)}/batch={batch}" for d in dates]
        folders = [f for f in folders if fs.exists(file_system(self.spark, f)[1])]
        if not folders:
            return self.spark.createDataFrame([], "record string, extraction_date date")
        got = self.spark.read.schema("record string").option("basePath", self.path).parquet(*folders)
        return got.select("record", F.col("extraction_date").cast("date").alias("extraction_date"))

    @staticmethod
    def _write(df: DataFrame, path: str, fmt: str) -> None:
        """Only the folders of this batch, which are new or were just removed."""
        df.write.mode("append").partitionBy("extraction_date", "batch").format(fmt).save(path)

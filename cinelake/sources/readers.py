"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.dates import date_from_path
from cinelake.functions.text import dataset_name, path_basename
from cinelake.session import materialize


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    sep: str = "|",
    header: bool = True,
    glob: str | None = "*.csv",
    recursive: bool = False,
) -> DataFrame:
    """Delimited text with a fixed schema.  Columns bind by position;
    unparseable numbers and empty fields become null, short rows are null-padded,
    extra fields dropped, quoted separators kept.  Only ``glob`` files are read."""
    reader = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.csv(path)


#: Column that a reader puts a malformed record's text into.
CORRUPT = "_corrupt_record"


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a table that a reader made with the column ``CORRUPT`` and that has the columns
    ``source_file``, ``split_start`` and ``split_row`` (see ``read_checked``); rejected rows are
    these and the record's text."""
    place = ["source_file", "split_start", "split_row"]
    accepted = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, *place)
    return accepted, parsed.filter(F.col(CORRUPT).isNotNull()).select(*place, F.col(CORRUPT).alias("record"))


def read_checked(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    fmt: str = "csv",
    glob: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """S1 / S2 with a reject table: delimited text or JSON lines, of which malformed records (a value that is
    not of its type, too few or too many fields, broken JSON) are not turned into nulls but go to the second
    table, with their file, the byte at which the part of it that a task read starts, and their place in
    the order of that task's rows.  Accepted and rejected rows are all rows.  The files are parsed by one scan, whose result
    is written to the shared folder."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(wide).format(fmt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("recursiveFileLookup", True).option("encoding", "UTF-8")
    if fmt == "csv":
        reader = reader.option("sep", "|").option("header", True).option("enforceSchema", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    parsed = reader.options(**options).load(path)
    meta = F.col("_metadata")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = parsed.select("*", meta["file_path"].alias("source_file"), meta["file_block_start"].alias("split_start"), row.alias("split_row"))
    return split_rejects(materialize(placed, "parsed"))


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, with_source: bool = False
) -> DataFrame:
    """JSON lines folder.  With a fixed schema absent keys are null and unknown
    keys ignored.  ``with_source`` adds the source file and its folder date (F7)."""
    reader = spark.read.option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("recursiveFileLookup", True).json(path)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path")).withColumn(
            "extraction_date", date_from_path(F.col("_metadata.file_path"))
        )
    return df


def read_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """S3: Parquet with partition discovery; naming columns prunes the scan early."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def landing_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Listing of a landing folder (path, file name, dataset, size, modified,
    landing date from the yyyy/MM/dd folder).
    The binaryFile source is only asked for metadata columns, so file contents are
    never read (content column pruned)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length", "modificationTime")
    return files.select(
        F.col("path"),
        path_basename("path").alias("file_name"),
        dataset_name("path").alias("dataset"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
        date_from_path("path").alias("landed_on"),  # yyyy/MM/dd folder, null if none
    )

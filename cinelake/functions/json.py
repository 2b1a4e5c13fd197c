"""JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project_json_keys(raw: ColumnOrName, schema: T.StructType | str) -> Column:
    """Keep only the wanted keys of a JSON object text.  A key that is absent
    becomes null, unknown keys are ignored, malformed text gives all-null fields."""
    return F.from_json(_c(raw), schema, {"mode": "PERMISSIVE"})


# Fixed schema of an object-created notification document (only the fields used).
OBJECT_EVENT_SCHEMA = T.StructType(
    [
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("eventVersion", T.StringType()),
                        T.StructField("eventSource", T.StringType()),
                        T.StructField("awsRegion", T.StringType()),
                        T.StructField("eventTime", T.StringType()),
                        T.StructField("eventName", T.StringType()),
                        T.StructField("userIdentity", T.StructType([T.StructField("principalId", T.StringType())])),
                        T.StructField(
                            "requestParameters", T.StructType([T.StructField("sourceIPAddress", T.StringType())])
                        ),
                        T.StructField(
                            "s3",
                            T.StructType(
                                [
                                    T.StructField("s3SchemaVersion", T.StringType()),
                                    T.StructField("configurationId", T.StringType()),
                                    T.StructField(
                                        "bucket",
                                        T.StructType(
                                            [
                                                T.StructField("name", T.StringType()),
                                                T.StructField(
                                                    "ownerIdentity",
                                                    T.StructType([T.StructField("principalId", T.StringType())]),
                                                ),
                                                T.StructField("arn", T.StringType()),
                                            ]
                                        ),
                                    ),
                                    T.StructField(
                                        "object",
                                        T.StructType(
                                            [
                                                T.StructField("key", T.StringType()),
                                                T.StructField("size", T.LongType()),
                                                T.StructField("eTag", T.StringType()),
                                                T.StructField("versionId", T.StringType()),
                                                T.StructField("sequencer", T.StringType()),
                                            ]
                                        ),
                                    ),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def event_object_location(doc: ColumnOrName, index: int = 0) -> dict[str, Column]:
    """bucket name and object key of Records[index] of an event document text (null
    if there is no such record).  ``event_records`` gives all of them."""
    rec = F.get(F.from_json(_c(doc), OBJECT_EVENT_SCHEMA)["Records"], F.lit(index))
    return {"bucket_name": rec["s3"]["bucket"]["name"], "object_key": rec["s3"]["object"]["key"]}


def event_records(doc: ColumnOrName) -> Column:
    """All records of an event document (explode the result for one row per record)."""
    return F.from_json(_c(doc), OBJECT_EVENT_SCHEMA)["Records"]

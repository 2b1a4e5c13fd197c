"""Property-based checks of the numbering operators on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cinelake import operators as op

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(keys=st.sets(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=400))
def test_surrogate_key_is_global_rank(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.id for r in op.surrogate_key(df, ["k"], "id").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys), start=1)}


@SETTINGS
@given(words=st.sets(st.text(alphabet="abcXYZ é", min_size=0, max_size=6), min_size=1, max_size=200))
def test_surrogate_key_strings_follow_spark_order(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    expected = {r.w: r.id for r in df.select("w", F.row_number().over(Window.orderBy("w")).alias("id")).collect()}
    got = {r.w: r.id for r in op.surrogate_key(df, ["w"], "id").collect()}
    assert got == expected


@SETTINGS
@given(n_rows=st.integers(min_value=1, max_value=500), n_parts=st.integers(min_value=1, max_value=60))
def test_balanced_split_is_ntile(spark, n_rows, n_parts):
    numbered, total = op.surrogate_key_counted(spark.range(n_rows).withColumnRenamed("id", "k"), ["k"], "rn")
    for known in (total, None):
        parts = op.balanced_split(numbered, "rn", n_parts, total=known)
        rows = parts.withColumn("nt", F.ntile(n_parts).over(Window.orderBy("rn"))).collect()
        assert all(r.part == r.nt for r in rows)

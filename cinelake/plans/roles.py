"""Film-shaped views of the driver's TPC-H-like test tables.

The test tables hold no films, so they play the roles below (every view is a Spark
job over the whole tables, so its work grows with them):

raw credits (film x artist x role)  = lineitem x orders x supplier
    id = l_orderkey, titles = 'Order#<key>', year = year(o_orderdate),
    runtime minutes = l_linenumber with 7 made null (exercises dropna),
    tag string = '<o_orderpriority>,<o_orderstatus>', rating = l_discount,
    votes = int(l_quantity), role = l_returnflag with 'N' as the null sentinel,
    artist = s_name.
raw details (film) = orders x per-order lineitem summary (orders without lines have
    no details, like ids the web service did not know)
    id = o_orderkey + 1000000, imdb_id = o_orderkey, release_date = 'yyyy-MM-dd' text,
    vote_average = 100 x max(l_discount), vote_count = sum(l_quantity),
    popularity = max(l_tax), budget = floor(sum(l_extendedprice)),
    revenue = floor(o_totalprice), runtime = number of lines,
    genres = [{1, priority}, {2, status}].
Genre classes: 'Fantasy' = status token F (LIKE '%,F%'), 'Sci-Fi' = priority token
1-URGENT (LIKE '%URGENT%').
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.plans.star import FilmColumns

# Fixed values of the binding.
TAG_PATTERNS = ("%URGENT%", "%,F%")
TAG_TOKENS = ("1-URGENT", "F")
ROLE_SENTINEL = "N"
EXTRACTION_DATE = dt.date(2024, 3, 27)
YEAR_RANGE = (1996, 2000)
TEST_COLUMNS = FilmColumns(pattern_a="%,F%", pattern_b="%URGENT%")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(s, li["l_suppkey"] == s["s_suppkey"])
    title = F.concat(F.lit("Order#"), F.col("l_orderkey").cast("string"))
    return j.select(
        F.col("l_orderkey").alias("id"),
        title.alias("tituloPincipal"),
        title.alias("tituloOriginal"),
        F.year("o_orderdate").alias("anoLancamento"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("tempoMinutos"),
        F.concat_ws(",", "o_orderpriority", "o_orderstatus").alias("genero"),
        F.col("l_discount").alias("notaMedia"),
        F.col("l_quantity").cast("int").alias("numeroVotos"),
        F.col("l_linestatus").alias("generoArtista"),
        F.col("l_returnflag").alias("personagem"),
        F.col("s_name").alias("nomeArtista"),
        F.col("s_nationkey").alias("anoNascimento"),
        F.lit(None).cast("int").alias("anoFalecimento"),
        F.lit("supplier").alias("profissao"),
        F.col("l_partkey").cast("string").alias("titulosMaisConhecidos"),
    )


def raw_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    summary = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.max("l_tax").alias("max_tax"),
        F.max("l_discount").alias("max_disc"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("gross"),
    )
    o = table(spark, sf_dir, "orders")
    j = o.join(summary, o["o_orderkey"] == summary["l_orderkey"], "inner")
    return j.select(
        (F.col("o_orderkey") + F.lit(1000000)).alias("id"),
        F.col("o_orderkey").alias("imdb_id"),
        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        (F.col("max_disc") * F.lit(100.0)).alias("vote_average"),
        F.col("qty").cast("long").alias("vote_count"),
        F.col("max_tax").alias("popularity"),
        F.floor("gross").cast("long").alias("budget"),
        F.floor("o_totalprice").cast("long").alias("revenue"),
        F.col("n_lines").alias("runtime"),
        F.array(
            F.struct(F.lit(1).cast("long").alias("id"), F.col("o_orderpriority").alias("name")),
            F.struct(F.lit(2).cast("long").alias("id"), F.col("o_orderstatus").alias("name")),
        ).alias("genres"),
    )


def orders_as_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Film list for the id pipeline (Q3): one row per order with its tag string."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat_ws(",", "o_orderpriority", "o_orderstatus").alias("genero")
    )


def films_with_near_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders_as_films`` where every fifth status tag has a letter more: it still holds the
    wanted tag as a substring, but is another token."""
    o = table(spark, sf_dir, "orders")
    near = F.when(F.col("o_orderkey") % 5 == 0, F.concat("o_orderstatus", F.lit("x"))).otherwise(F.col("o_orderstatus"))
    return o.select(F.col("o_orderkey").alias("id"), F.concat_ws(",", "o_orderpriority", near).alias("genero"))

"""Every operator and pipeline bound to the driver's test tables.

``QUERIES[name](spark, sf_dir) -> DataFrame``; the matching DuckDB oracle text is in
``registry_sql.ORACLE_SQL``.  Each query reads whole tables (or data Spark derives
from them); limits appear only where the limit is the feature (top-k, request cap).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake import functions as fx
from cinelake import operators as op
from cinelake.plans import analytics as an
from cinelake.plans import enrich as en
from cinelake.plans import star as st
from cinelake.plans import trusted as tr
from cinelake.plans.roles import (
    EXTRACTION_DATE,
    ROLE_SENTINEL,
    TAG_PATTERNS,
    TAG_TOKENS,
    TEST_COLUMNS,
    YEAR_RANGE,
    films_with_near_tags,
    orders_as_films,
    raw_credits,
    raw_details,
    table,
)
from cinelake.session import materialize, shared_dir
from cinelake.sources.readers import landing_inventory, read_checked, read_delimited, read_json_lines
from cinelake.sources.schemas import CREDIT_COLUMNS_DROPPED, STAR_NOT_NULL
from cinelake.sources.sinks import land_once, publish_views, register_tables, write_id_list, write_json_balanced, write_parquet
from cinelake.streaming.enrichment import stream_enrichment
from cinelake.streaming.ingest import stream_dedup, stream_ingest, stream_trusted_details

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- shared stages


def trusted_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    credits = tr.trusted_credits(raw_credits(spark, d), tag_patterns=TAG_PATTERNS, sentinel=ROLE_SENTINEL)
    details = tr.trusted_details(raw_details(spark, d), extraction_date=EXTRACTION_DATE)
    return credits, details


def joined(spark: SparkSession, d: str) -> DataFrame:
    credits, details = trusted_pair(spark, d)
    return st.joined_view(credits, details, TEST_COLUMNS)


def star(spark: SparkSession, d: str) -> st.Star:
    credits, details = trusted_pair(spark, d)
    return st.build_star(credits, details, TEST_COLUMNS)


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return tr.candidate_ids(orders_as_films(spark, d), "id", "genero", TAG_TOKENS)


def lineitem(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem")


def orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders")


# ---------------------------------------------------------------- 2.1 sources


@query("scan_parquet")
def _scan_parquet(spark, d):
    return orders(spark, d)


@query("landing_inventory")
def _landing_inventory(spark, d):
    # orders landed under dated folders; the listing is joined to what the files hold
    o = orders(spark, d).withColumn("year", F.year("o_orderdate"))
    base = shared_dir(spark, "inventory")
    for r in o.select("year").distinct().collect():  # bounded by the calendar
        land_once(o.filter(F.col("year") == r.year).drop("year"), f"{base}/Orders/{r.year}/01/01", "csv")
    held = read_delimited(spark, base, "o_orderkey long", sep=",", header=False, recursive=True)
    held = held.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    files = landing_inventory(spark, base, "*.csv").filter("size_bytes > 0")
    rows = files.join(held, F.regexp_extract("path", "[^/]+$", 0) == F.regexp_extract("file", "[^/]+$", 0))
    return rows.groupBy("landed_on").agg(F.sum("rows").alias("n_rows"))


@query("csv_round_trip")
def _csv_round_trip(spark, d):
    # Quoted separators, a null marker and a short last field
    part = table(spark, d, "part")
    base = shared_dir(spark, "csv")
    text = part.withColumn("p_name", F.concat(F.col("p_name"), F.lit("|x"))).withColumn(
        "p_size", F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).otherwise(F.lit("\\N"))
    )
    land_once(text, base, "csv", sep="|", header=True)
    return read_delimited(spark, base, part.schema)


@query("csv_rejects")
def _csv_rejects(spark, d):
    # S1 with rejects: a size that is no number, and a record with a field too many
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    size = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("x"), "p_size")).when(F.col("p_partkey") % 11 == 0, F.concat("p_size", F.lit("|9")))
    line = F.concat_ws("|", "p_partkey", "p_name", F.coalesce(size, F.col("p_size").cast("string")))
    base = shared_dir(spark, "csv-rejects")
    part.select(line.alias("line")).write.text(base)
    accepted, rejected = read_checked(spark, base, part.schema, header=False)
    none = F.lit(None).cast("string")
    return accepted.select(*part.columns, none.alias("record")).unionByName(
        rejected.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in part.schema.fields], "record")
    )


@query("json_round_trip")
def _json_round_trip(spark, d):
    # Balanced JSON files of at most 100 records, read back with a schema
    c = table(spark, d, "customer")
    base = shared_dir(spark, "json")
    write_json_balanced(c, base, ["c_custkey"], 100)
    return read_json_lines(spark, base, c.schema).select(*c.columns)


@query("json_file_sizes")
def _json_file_sizes(spark, d):
    # Records per file, and in how many files
    c = table(spark, d, "customer")
    base = shared_dir(spark, "json")
    write_json_balanced(c, base, ["c_custkey"], 100)
    files = read_json_lines(spark, base, c.schema).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("records"))
    return files.groupBy("records").agg(F.count(F.lit(1)).alias("files"))


@query("partitioned_rewrite")
def _partitioned_rewrite(spark, d):
    # A partitioned table of which one partition is written again
    ev = table(spark, d, "events")
    base = shared_dir(spark, "partitioned")
    write_parquet(ev, base, mode="overwrite", partition_by=["event_type"])
    write_parquet(ev.filter("event_type = 'click'"), base, mode="overwrite", partition_by=["event_type"])
    return spark.read.parquet(base).select(*ev.columns)


@query("id_list_round_trip")
def _id_list_round_trip(spark, d):
    base = shared_dir(spark, "ids")
    write_id_list(candidates(spark, d), base)
    return read_delimited(spark, base, "id long", header=False)


@query("land_once")
def _land_once(spark, d):
    # The second landing finds a complete one and is skipped
    o = orders(spark, d)
    base = shared_dir(spark, "landed")
    land_once(o, base, "parquet")
    land_once(o.limit(1), base, "parquet")
    return spark.read.parquet(base)


@query("refined_round_trip")
def _refined_round_trip(spark, d):
    # The star built twice from different credits; the second is what is read
    base = shared_dir(spark, "refined")
    credits, details = trusted_pair(spark, d)
    st.write_star(st.build_star(credits.filter("id % 2 = 0"), details, TEST_COLUMNS), base)
    st.write_star(st.build_star(credits, details, TEST_COLUMNS), base)
    return st.read_star(spark, base).fact


@query("catalogue_table")
def _catalogue_table(spark, d):
    # A written folder as a catalogue table, queried with SQL
    base = shared_dir(spark, "catalogue")
    name = f"orders_{base.rsplit('-', 1)[1]}"
    write_parquet(orders(spark, d), f"{base}/{name}")
    register_tables(spark, base, [name])
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n_orders FROM {name} GROUP BY o_orderstatus")


@query("schema_check")
def _schema_check(spark, d):
    # V6: named differences between a table and an expected schema, beside its rows
    c = table(spark, d, "customer")
    wanted = T._parse_datatype_string("c_custkey long, c_name string, c_nationkey long, c_phone string, c_mktsegment string")
    found = spark.createDataFrame([(x,) for x in op.schema_diff(c.schema, wanted)], "difference string")
    return found.join(c.agg(F.count(F.lit(1)).alias("n_rows")))


@query("sql_view")
def _sql_view(spark, d):
    joined(spark, d).createOrReplaceTempView("joined_films")
    return spark.sql("SELECT DISTINCT id FROM joined_films")


# ---------------------------------------------------------------- 2.2 projections and filters


@query("drop_columns")
def _drop_columns(spark, d):
    return op.drop_columns(raw_credits(spark, d), CREDIT_COLUMNS_DROPPED)


@query("rename_columns")
def _rename_columns(spark, d):
    return op.rename_columns(orders(spark, d), {"o_orderkey": "id", "o_orderdate": "release_ts"})


@query("project_alias")
def _project_alias(spark, d):
    return op.project_alias(
        orders(spark, d),
        {
            "id": "o_orderkey",
            "main_title": F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")),
            "release_date": F.col("o_orderdate").cast("date"),
            "genres": F.concat_ws(",", "o_orderpriority", "o_orderstatus"),
        },
    )


@query("reorder_columns")
def _reorder_columns(spark, d):
    return op.reorder_columns(lineitem(spark, d), ["l_linenumber", "l_orderkey", "l_shipdate"])


@query("filter_like_any")
def _filter_like_any(spark, d):
    return op.filter_like_any(films_with_near_tags(spark, d), "genero", TAG_PATTERNS)


@query("filter_tag_token")
def _filter_tag_token(spark, d):
    return op.filter_tag_token(films_with_near_tags(spark, d), "genero", TAG_TOKENS)


@query("dropna_any")
def _dropna_any(spark, d):
    li = lineitem(spark, d).select(
        "l_orderkey",
        "l_partkey",
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("line"),
    )
    return op.dropna_any(li)


@query("filter_min_votes")
def _filter_min_votes(spark, d):
    return op.filter_min(lineitem(spark, d), "l_quantity", tr.MIN_VOTES)


@query("filter_nonzero")
def _filter_nonzero(spark, d):
    li = lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return op.filter_nonzero(li, ["l_discount", "l_tax"])


@query("sentinel_to_null")
def _sentinel_to_null(spark, d):
    li = lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return op.replace_sentinel(li, "l_returnflag", ROLE_SENTINEL)


@query("add_literal")
def _add_literal(spark, d):
    return op.add_literal(orders(spark, d), "extraction_date", EXTRACTION_DATE, "date")


@query("json_project_keys")
def _json_project_keys(spark, d):
    ev = table(spark, d, "events")
    parsed = fx.project_json_keys("props", "k BIGINT, missing STRING")
    return ev.select("event_id", parsed.alias("j")).select("event_id", "j.k", "j.missing")


@query("search_like")
def _search_like(spark, d):
    return op.search_like(table(spark, d, "part"), "p_name", "%gear%")


@query("predicate_logic")
def _predicate_logic(spark, d):
    c = F.col
    pred = ((c("l_returnflag") == "R") & (c("l_quantity") >= 30)) | (
        ~(c("l_linestatus") == "O") & (c("l_discount") != 0.05)
    )
    return op.filter_where(lineitem(spark, d), pred).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# ---------------------------------------------------------------- 2.3 joins


@query("join_inner")
def _join_inner(spark, d):
    return joined(spark, d)


def _star_inputs(spark, d) -> st.StarInputs:
    credits, details = trusted_pair(spark, d)
    return st.prepare_star(credits, details, TEST_COLUMNS)


@query("lookup_date_key")
def _lookup_date_key(spark, d):
    p = _star_inputs(spark, d)
    rows = st.fact_rows(p.joined, TEST_COLUMNS)
    return op.lookup_key(rows, p.dates, "release_date", "date", "id", "id_date")


@query("lookup_member_key")
def _lookup_member_key(spark, d):
    p = _star_inputs(spark, d)
    rows = st.fact_rows(p.joined, TEST_COLUMNS)
    return op.lookup_key(rows, p.actors, "artist_name", "name", "id", "id_actor")


@query("star_flatten")
def _star_flatten(spark, d):
    return st.star_flatten(star(spark, d))


@query("ids_found")
def _ids_found(spark, d):
    return op.ids_found(candidates(spark, d), raw_details(spark, d), "id", "imdb_id")


@query("ids_missing")
def _ids_missing(spark, d):
    return op.ids_missing(candidates(spark, d), raw_details(spark, d), "id", "imdb_id")


# ---------------------------------------------------------------- 2.4 aggregates


@query("group_count")
def _group_count(spark, d):
    return op.group_count(lineitem(spark, d), ["l_suppkey"])


@query("row_count")
def _row_count(spark, d):
    return op.row_count(lineitem(spark, d))


@query("count_distinct")
def _count_distinct(spark, d):
    return op.count_distinct(lineitem(spark, d), "l_orderkey")


@query("count_distinct_tuple")
def _count_distinct_tuple(spark, d):
    return op.count_distinct_tuple(lineitem(spark, d), ["l_orderkey", "l_linenumber"])


@query("group_count_distinct")
def _group_count_distinct(spark, d):
    return op.group_count_distinct(lineitem(spark, d), ["l_suppkey"], "l_orderkey")


@query("distinct_sketches")
def _distinct_sketches(spark, d):
    # A5 by mergeable sketches, one year at a time; the estimate of each flag is held against the exact count
    li = lineitem(spark, d).select(F.year("l_shipdate").alias("year"), "l_returnflag", "l_partkey")
    sketches = op.SketchTable(spark, shared_dir(spark, "sketches"), "year", ["l_returnflag"])
    for r in li.select("year").distinct().collect():  # bounded by the calendar
        sketches.add(li.filter(F.col("year") == r.year), "l_partkey")
    exact = op.group_count_distinct(li, ["l_returnflag"], "l_partkey")
    exact = exact.withColumnsRenamed({c: "exact" for c in exact.columns if c != "l_returnflag"})
    both = exact.join(sketches.estimate(["l_returnflag"]), "l_returnflag")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 4 * sketches.error * F.col("exact") + 1
    return both.select("l_returnflag", "exact", near.alias("within_bound"))


@query("catalogue_swap")
def _catalogue_swap(spark, d):
    # A view that shows one build and then the next, over tables with column statistics
    base = shared_dir(spark, "builds")
    name = f"orders_{base.rsplit('-', 1)[1]}"
    for n, rows in enumerate((orders(spark, d).filter("o_orderkey % 2 = 0"), orders(spark, d))):
        write_parquet(rows, f"{base}/build-{n}/{name}")
        publish_views(spark, f"{base}/build-{n}", [name])
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n_orders FROM {name} GROUP BY o_orderstatus")


@query("describe_profile")
def _describe_profile(spark, d):
    return op.describe_profile(lineitem(spark, d), ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"])


@query("corr_pearson")
def _corr_pearson(spark, d):
    # nulls on either side: pairs count only when complete
    li = lineitem(spark, d)
    x = F.when(F.col("l_linenumber") != 3, F.col("l_quantity"))
    y = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice"))
    return li.groupBy("l_returnflag").agg(F.round(op.pearson(x, y), 6).alias("corr"))


@query("regression_line")
def _regression_line(spark, d):
    return op.fit_line(lineitem(spark, d), "l_quantity", "l_extendedprice", ["l_returnflag"]).drop("corr")


@query("enrichment_rate")
def _enrichment_rate(spark, d):
    return en.enrichment_rate(candidates(spark, d), raw_details(spark, d), "id", "imdb_id")


# ---------------------------------------------------------------- 2.5 windows


@query("surrogate_key")
def _surrogate_key(spark, d):
    keys = lineitem(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return op.surrogate_key(keys, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "id")


@query("seasonal_share")
def _seasonal_share(spark, d):
    return an.seasonal_share(star(spark, d))


@query("top_n_per_group")
def _top_n_per_group(spark, d):
    return an.top_popular_per_genre(star(spark, d), 10)


@query("batch_assign")
def _batch_assign(spark, d):
    return en.request_batches(candidates(spark, d), "id", en.BATCH_SIZE)


@query("balanced_split")
def _balanced_split(spark, d):
    ev = table(spark, d, "events").select("event_id")
    numbered, total = op.surrogate_key_counted(ev, ["event_id"], "rn")
    return op.balanced_split(numbered, "rn", 101, total=total)


# ---------------------------------------------------------------- 2.6 sorts and limits


@query("sort_asc")
def _sort_asc(spark, d):
    # the position is read from the sorted rows
    return op.number_in_order(op.sort_asc(orders(spark, d), ["o_orderdate", "o_orderkey"]), "position")[0]


@query("sort_desc_count")
def _sort_desc_count(spark, d):
    counts = op.sort_desc(op.group_count(lineitem(spark, d), ["l_suppkey"]), "count", ["l_suppkey"])
    return op.number_in_order(counts, "position")[0]


@query("top_k")
def _top_k(spark, d):
    return op.top_k(orders(spark, d), [F.col("o_totalprice").desc(), "o_orderkey"], 10)


@query("capped_ids")
def _capped_ids(spark, d):
    return op.capped(candidates(spark, d), "id", 500)


# ---------------------------------------------------------------- 2.7 set operations


@query("distinct_rows")
def _distinct_rows(spark, d):
    return op.distinct_rows(lineitem(spark, d), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("drop_duplicates")
def _drop_duplicates(spark, d):
    details = raw_details(spark, d)
    return op.drop_duplicates(details.unionByName(details))


@query("distinct_ids")
def _distinct_ids(spark, d):
    return op.distinct_values(raw_credits(spark, d), "id")


# ---------------------------------------------------------------- 2.8 scalar functions


@query("parse_date")
def _parse_date(spark, d):
    o = orders(spark, d)
    text = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", fx.parse_date(text).alias("release_date"))


@query("date_parts")
def _date_parts(spark, d):
    o = orders(spark, d)
    parts = fx.date_parts(F.col("o_orderdate").cast("date"))
    return o.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("quarter_label")
def _quarter_label(spark, d):
    return orders(spark, d).select("o_orderkey", fx.quarter_label(F.col("o_orderdate").cast("date")).alias("quarter"))


@query("filter_isin")
def _filter_isin(spark, d):
    o = orders(spark, d).withColumn("month", F.month("o_orderdate"))
    return op.filter_isin(o, "month", [1, 2, 3])


@query("classify_tags")
def _classify_tags(spark, d):
    films = orders_as_films(spark, d)
    return films.withColumn("id_genre", fx.classify_tags("genero", TEST_COLUMNS.pattern_a, TEST_COLUMNS.pattern_b))


@query("label_codes")
def _label_codes(spark, d):
    films = orders_as_films(spark, d)
    code = fx.classify_tags("genero", TEST_COLUMNS.pattern_a, TEST_COLUMNS.pattern_b)
    return films.select("id", fx.label_codes(code).alias("genre"))


def _landing_paths(spark, d) -> DataFrame:
    o = orders(spark, d)
    folder = F.concat(F.lit("Raw/TMDB/JSON/"), fx.date_to_path("o_orderdate"))
    # file inside the dated folder for even keys, bare folder with trailing slash for odd
    path = F.when(F.col("o_orderkey") % 2 == 0, F.concat(folder, F.lit("/details-part-0.json"))).otherwise(
        F.concat(folder, F.lit("/"))
    )
    return o.select("o_orderkey", path.alias("path"))


@query("date_from_path")
def _date_from_path(spark, d):
    paths = _landing_paths(spark, d)
    return paths.withColumn("extraction_date", fx.date_from_path("path"))


@query("date_to_path")
def _date_to_path(spark, d):
    return orders(spark, d).select("o_orderkey", fx.date_to_path("o_orderdate").alias("date_path"))


@query("dataset_name")
def _dataset_name(spark, d):
    c = table(spark, d, "customer")
    file_path = F.concat(F.lit("data/"), F.col("c_mktsegment"), F.lit(" Segment.csv"))
    return c.select("c_custkey", file_path.alias("file_path"), fx.dataset_name(file_path).alias("dataset"))


@query("split_tags")
def _split_tags(spark, d):
    return orders_as_films(spark, d).select("id", fx.split_tags("genero").alias("tags"))


@query("path_basename")
def _path_basename(spark, d):
    o = orders(spark, d)
    p = F.concat(
        F.lit("Raw/Local/CSV/Orders/"), fx.date_to_path("o_orderdate"), F.lit("/orders-"),
        F.col("o_orderkey").cast("string"), F.lit(".csv"),
    )
    return o.select("o_orderkey", fx.path_basename(p).alias("file_name"))


@query("landing_path")
def _landing_path(spark, d):
    o = orders(spark, d)
    p = fx.landing_path(F.lit("Raw"), F.lit("Local"), F.lit("CSV"), fx.dataset_name(F.lit("orders.csv")), "o_orderdate", F.lit("orders.csv"))
    return o.select("o_orderkey", p.alias("landing_path"))


@query("json_nested_path")
def _json_nested_path(spark, d):
    ev = table(spark, d, "events")
    record = F.struct(
        F.lit("ObjectCreated:Put").alias("eventName"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("eventTime"),
        F.struct(
            F.struct(F.concat(F.lit("lake-"), F.col("event_type")).alias("name")).alias("bucket"),
            F.struct(
                F.concat(
                    F.lit("Raw/Events/JSON/"), fx.date_to_path("ts"), F.lit("/event-"),
                    F.col("event_id").cast("string"), F.lit(".json"),
                ).alias("key"),
                F.lit(1024).cast("long").alias("size"),
            ).alias("object"),
        ).alias("s3"),
    )
    docs = ev.select("event_id", F.to_json(F.struct(F.array(record).alias("Records"))).alias("doc"))
    loc = fx.event_object_location("doc")
    return docs.select("event_id", loc["bucket_name"].alias("bucket_name"), loc["object_key"].alias("object_key"))


@query("event_records")
def _event_records(spark, d):
    # documents of no, one and two records; one row per record
    ev = table(spark, d, "events")
    key = F.concat(F.lit("k"), F.col("event_id").cast("string"))
    record = F.struct(F.struct(F.struct(key.alias("key")).alias("object")).alias("s3"))
    records = F.slice(F.array(record, record), 1, (F.col("event_id") % 3).cast("int"))
    docs = ev.select("event_id", F.to_json(F.struct(records.alias("Records"))).alias("doc"))
    first = docs.select("event_id", "doc", fx.event_object_location("doc")["object_key"].alias("first_key"))
    return first.select("event_id", "first_key", F.posexplode_outer(fx.event_records("doc")).alias("pos", "r")).select(
        "event_id", "first_key", "pos", F.col("r.s3.object.key").alias("object_key")
    )


@query("scale_units")
def _scale_units(spark, d):
    o = orders(spark, d)
    per_year = o.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue")
    )
    units = fx.scale_units("revenue")
    return per_year.select("year", units["millions"].alias("revenue_millions"), units["billions"].alias("revenue_billions"))


# ---------------------------------------------------------------- 2.9 streaming


# microsecond timestamps survive the JSON round trip (the default keeps milliseconds)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _land_events_json(spark, d, landing: str, copies: int = 1) -> DataFrame:
    ev = table(spark, d, "events").withColumn("event_date", F.to_date("ts"))
    ev = ev.repartition("event_date")  # a file per date and copy
    for _ in range(copies):
        ev.write.mode("append").option("timestampNTZFormat", TS_FORMAT).partitionBy("event_date").json(landing)
    return ev


@query("stream_ingest")
def _stream_ingest(spark, d):
    base = shared_dir(spark, "stream-ingest")
    ev = _land_events_json(spark, d, f"{base}/landing")
    out = stream_ingest(spark, f"{base}/landing", ev.schema, f"{base}/out", f"{base}/checkpoint", "json", max_files_per_trigger=100,
        timestampNTZFormat=TS_FORMAT,
    )
    return out.select(*ev.columns)


@query("stream_dedup")
def _stream_dedup(spark, d):
    base = shared_dir(spark, "stream-dedup")
    ev = _land_events_json(spark, d, f"{base}/landing", copies=2)
    out = stream_dedup(spark, f"{base}/landing", ev.schema, ["event_id"], f"{base}/out", f"{base}/checkpoint", "json",
        max_files_per_trigger=100, timestampNTZFormat=TS_FORMAT,
    )
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("stream_trusted")
def _stream_trusted(spark, d):
    # films landed as several files in two dated folders, some records twice, a file per batch
    raw = raw_details(spark, d)
    base = shared_dir(spark, "stream-trusted")
    for parity, day in ((0, "27"), (1, "28")):
        films = raw.filter(F.col("imdb_id") % 2 == parity)
        films.repartition(3).write.json(f"{base}/landing/2024/03/{day}")
        films.filter(F.col("imdb_id") % 10 == parity).repartition(1).write.mode("append").json(f"{base}/landing/2024/03/{day}")
    return stream_trusted_details(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", raw.schema, max_files_per_trigger=4)


@query("stream_recheckpoint")
def _stream_recheckpoint(spark, d):
    # The checkpoint is lost between drains and the trigger size changes; files and records land once
    raw = raw_details(spark, d)
    base = shared_dir(spark, "stream-recheckpoint")
    for parity, day in ((0, "27"), (1, "28")):
        films = raw.filter(F.col("imdb_id") % 2 == parity)
        films.repartition(2).write.json(f"{base}/landing/2024/03/{day}")
        stream_trusted_details(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint{day}", raw.schema, max_files_per_trigger=1 + parity * 4)
        films.filter(F.col("imdb_id") % 10 == parity).repartition(1).write.mode("append").json(f"{base}/landing/2024/03/{day}")
    return stream_trusted_details(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", raw.schema)


@query("stream_enrich")
def _stream_enrich(spark, d):
    # Q4 on arrival: films and details land in turns, so that some films wait for their details and some
    # details for their film; two drains with one checkpoint
    base = shared_dir(spark, "stream-enrich")
    films, details = orders_as_films(spark, d), raw_details(spark, d).select("imdb_id", "title")
    out = None
    for turn in (0, 1):
        films.filter(F.col("id") % 2 == turn).repartition(2).write.mode("append").option("header", True).option("sep", "|").csv(f"{base}/credits")
        details.filter(F.floor(F.col("imdb_id") / 2) % 2 == turn).repartition(2).write.mode("append").json(f"{base}/details")
        out = stream_enrichment(spark, f"{base}/credits", f"{base}/details", f"{base}/events", f"{base}/checkpoint", films.schema, details.schema, tags=TAG_TOKENS)
    return out.select("id", (F.col("status") == "found").alias("found"))


@query("stream_dedup_window")
def _stream_dedup_window(spark, d):
    # T3 with a watermark: each event lands twice, those of the first drain's last two days once more with the second
    base = shared_dir(spark, "stream-dedup-window")
    ev = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = ev.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    middle = F.lit(first) + F.expr(f"make_interval(0, 0, 0, {(last - first).days // 2})")
    out = None
    for rows in (ev.filter(F.col("ts") < middle), ev.filter(F.col("ts") >= middle - F.expr("interval 2 days"))):
        for _ in range(2):
            rows.coalesce(4).write.mode("append").option("timestampFormat", TS_FORMAT).json(f"{base}/landing")
        out = stream_dedup(spark, f"{base}/landing", ev.schema, ["event_id"], f"{base}/out", f"{base}/checkpoint", "json",
            watermark=("ts", "4 days"), timestampFormat=TS_FORMAT,
        )
    return out.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")


# ---------------------------------------------------------------- 2.11 data quality


@query("stage_funnel")
def _stage_funnel(spark, d):
    raw = op.rename_columns(op.drop_columns(raw_credits(spark, d), tr.CREDIT_COLUMNS_DROPPED), tr.CREDIT_RENAMES)
    tagged = op.filter_like_any(raw, "genero", TAG_PATTERNS)
    complete = op.dropna_any(op.drop_duplicates(tagged))
    voted = op.filter_min(complete, "numeroVotos", tr.MIN_VOTES)
    return op.stage_counts([("raw", raw), ("tag_filter", tagged), ("dedup_dropna", complete), ("min_votes", voted)])


@query("stage_funnel_observed")
def _stage_funnel_observed(spark, d):
    # V1 in one pass: the counts of all stages, taken while the trusted credits are written
    funnel = op.Funnel()
    materialize(tr.trusted_credits(raw_credits(spark, d), tag_patterns=TAG_PATTERNS, sentinel=ROLE_SENTINEL, counted=funnel), "trusted-credits")
    return funnel.rows(spark)


@query("audit_gate")
def _audit_gate(spark, d):
    # V3-V5 as a gate: a build with holes in a dimension is written and audited, but the one before stays current
    base = shared_dir(spark, "gate")
    s = star(spark, d)
    st.write_star(s, base)
    holes = st.Star(s.dim_actor.filter("id % 5 <> 0"), s.dim_date, s.dim_movie, s.fact, s.dim_genre)
    try:
        folder = st.write_star(holes, base)
    except st.AuditFailed as failed:
        folder = failed.folder
    current = st.read_star(spark, base).dim_actor.agg(F.count(F.lit(1)).alias("current_actors"))
    return spark.read.parquet(f"{folder}/audit").withColumn("one", F.lit(1)).join(current.withColumn("one", F.lit(1)), "one").drop("one")


@query("key_registry")
def _key_registry(spark, d):
    # W1 over builds: a first build holds some suppliers' names, a second all of them
    names = table(spark, d, "supplier").select(F.col("s_name").alias("name"), "s_suppkey")
    known = op.KeyRegistry(spark, shared_dir(spark, "keys"))
    known.assign(names.filter("s_suppkey % 3 = 0"), ["name"])
    return known.assign(names, ["name"])


@query("rebuilt_artists")
def _rebuilt_artists(spark, d):
    # Q5 over builds: artists of the first build keep their ids when others join
    credits, details = trusted_pair(spark, d)
    keys = shared_dir(spark, "keys")
    st.dim_actor(credits.filter("id % 50 = 0"), TEST_COLUMNS, op.KeyRegistry(spark, keys))
    return st.dim_actor(credits, TEST_COLUMNS, op.KeyRegistry(spark, keys)).select("id", "name", "num_movies")


@query("key_consistency")
def _key_consistency(spark, d):
    credits, _ = trusted_pair(spark, d)
    attrs = ["tituloPrincipal", "tituloOriginal", "anoLancamento", "tempoMinutos", "genero", "notaMedia", "numeroVotos"]
    return op.key_consistency(credits, "id", attrs)


@query("pk_violations")
def _pk_violations(spark, d):
    return op.pk_violations(star(spark, d).fact, ["id_movie", "id_actor", "id_date", "id_genre"])


@query("fk_violations")
def _fk_violations(spark, d):
    # dimensions with holes, so that there is something to count
    s = star(spark, d)
    refs = [
        ("id_movie", s.dim_movie.filter("id % 7 <> 0"), "id"),
        ("id_actor", s.dim_actor.filter("id % 5 <> 0"), "id"),
        ("id_date", s.dim_date.filter("month <> 5"), "id"),
        ("id_genre", s.dim_genre, "id"),
    ]
    return op.fk_violations(s.fact, refs)


@query("null_violations")
def _null_violations(spark, d):
    return op.null_violations(star(spark, d).fact, STAR_NOT_NULL["fact_movie_actor"] + ["actor_role"])


# ---------------------------------------------------------------- 2.12 pipelines


@query("trusted_credits")
def _trusted_credits(spark, d):
    return trusted_pair(spark, d)[0]


@query("trusted_details")
def _trusted_details(spark, d):
    return trusted_pair(spark, d)[1]


@query("candidate_ids")
def _candidate_ids(spark, d):
    return candidates(spark, d)


@query("enrich_ids")
def _enrich_ids(spark, d):
    return en.mark_found(candidates(spark, d), raw_details(spark, d), "id", "imdb_id")


@query("dim_actor")
def _dim_actor(spark, d):
    return st.dim_actor(trusted_pair(spark, d)[0], TEST_COLUMNS)


@query("dim_date")
def _dim_date(spark, d):
    return st.dim_date(trusted_pair(spark, d)[1], TEST_COLUMNS)


@query("dim_movie")
def _dim_movie(spark, d):
    return st.dim_movie(*trusted_pair(spark, d), TEST_COLUMNS)


@query("fact_build")
def _fact_build(spark, d):
    return star(spark, d).fact


@query("dim_genre")
def _dim_genre(spark, d):
    return star(spark, d).dim_genre


@query("releases_per_year")
def _releases_per_year(spark, d):
    return an.releases_per_year(star(spark, d))


@query("snapshot_films")
def _snapshot_films(spark, d):
    # every second film was fetched again later, with another popularity
    credits, details = trusted_pair(spark, d)
    later = details.filter("imdb_id % 2 = 0").withColumns(
        {"popularity": F.col("popularity") + 1, "extraction_date": F.date_add("extraction_date", 5)}
    )
    return an.popularity_per_year(st.build_star(credits, details.unionByName(later), TEST_COLUMNS))


@query("mixed_genre_films")
def _mixed_genre_films(spark, d):
    # films some of whose credits carry another tag string, and so another genre class
    credits, details = trusted_pair(spark, d)
    more = (F.col("id") % 3 == 0) & (F.col("tempoMinutos") % 2 == 0)
    credits = credits.withColumn("genero", F.when(more, F.concat("genero", F.lit(",F"))).otherwise(F.col("genero")))
    return an.budget_revenue_per_year(st.build_star(credits, details, TEST_COLUMNS), *YEAR_RANGE)


@query("popularity_per_year")
def _popularity_per_year(spark, d):
    return an.popularity_per_year(star(spark, d))


@query("budget_revenue_per_year")
def _budget_revenue_per_year(spark, d):
    return an.budget_revenue_per_year(star(spark, d), *YEAR_RANGE)


@query("budget_revenue_fit")
def _budget_revenue_fit(spark, d):
    return an.budget_revenue_fit(star(spark, d))


@query("rating_popularity_fit")
def _rating_popularity_fit(spark, d):
    return an.rating_popularity_fit(star(spark, d))


@query("top_artists_popularity")
def _top_artists_popularity(spark, d):
    return an.top_artists_popularity(star(spark, d), 10)


@query("top_artists_revenue")
def _top_artists_revenue(spark, d):
    return an.top_artists_revenue(star(spark, d), 10)


@query("artist_recurrence")
def _artist_recurrence(spark, d):
    return an.artist_recurrence(star(spark, d))


@query("rating_by_genre")
def _rating_by_genre(spark, d):
    return an.rating_by_genre(star(spark, d))

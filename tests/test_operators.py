
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from cinelake import functions as fx
from cinelake import operators as op


def test_like_any_vs_exact_token(spark):
    df = spark.createDataFrame(
        [(1, "Action,Sci-Fi"), (2, "Fantasy,Sci-Fi"), (3, "Drama"), (4, "Science Fantasyland"), (5, None)],
        "id int, genero string",
    )
    like = {r.id for r in op.filter_like_any(df, "genero", ["%Sci-Fi%", "%Fantasy%"]).collect()}
    token = {r.id for r in op.filter_tag_token(df, "genero", ["Sci-Fi", "Fantasy"]).collect()}
    assert like == {1, 2, 4}
    assert token == {1, 2}


def test_dropna_before_sentinel(spark):
    df = spark.createDataFrame([(1, "\\N"), (2, None), (3, "Hero")], "id int, role string")
    out = op.replace_sentinel(op.dropna_any(df), "role")
    assert sorted((r.id, r.role) for r in out.collect()) == [(1, None), (3, "Hero")]


def test_filter_nonzero_and_min(spark):
    df = spark.createDataFrame([(1, 10, 5, 29), (2, 0, 5, 40), (3, None, 5, 40), (4, 7, 7, 30)], "id int, a int, b int, v int")
    kept = op.filter_min(op.filter_nonzero(df, ["a", "b"]), "v", 30)
    assert [r.id for r in kept.collect()] == [4]


def test_classify_and_label(spark):
    df = spark.createDataFrame([("Fantasy",), ("Sci-Fi",), ("Fantasy,Sci-Fi",), ("Drama",)], "g string")
    out = df.select("g", fx.classify_tags("g", "%Fantasy%", "%Sci-Fi%").alias("c"))
    out = out.withColumn("label", fx.label_codes("c"))
    got = {r.g: (r.c, r.label) for r in out.collect()}
    assert got == {
        "Fantasy": (1, "Fantasy"),
        "Sci-Fi": (2, "Sci-Fi"),
        "Fantasy,Sci-Fi": (3, "Fantasy/Sci-Fi"),
        "Drama": (None, None),
    }


def test_dates_and_paths(spark):
    df = spark.createDataFrame(
        [("2005-05-17", "../2024/03/27/"), ("", "../2024/03/27"), ("bad", "Raw/TMDB/JSON/2024/03/27/details-part-0.json")],
        "d string, p string",
    )
    out = df.select(
        fx.parse_date("d").alias("d"),
        fx.date_from_path("p").alias("x"),
    ).withColumn("q", fx.quarter_label("d"))
    rows = out.collect()
    assert rows[0].d == dt.date(2005, 5, 17) and rows[0].q == "Q2"
    assert rows[1].d is None and rows[1].q is None  # null date never becomes Q4
    assert {r.x for r in rows} == {dt.date(2024, 3, 27)}
    names = spark.createDataFrame([("Filmes E Series.csv",), ("movies.csv",)], "f string")
    got = [r[0] for r in names.select(fx.dataset_name("f")).collect()]
    assert got == ["Filmes e series", "Movies"]
    path = spark.range(1).select(
        fx.landing_path(F.lit("Raw"), F.lit("Local"), F.lit("CSV"), F.lit("Movies"), F.lit(dt.date(2024, 3, 20)), F.lit("movies.csv"))
    ).first()[0]
    assert path == "Raw/Local/CSV/Movies/2024/03/20/movies.csv"


def test_event_document_path(spark):
    doc = (
        '{"Records":[{"eventName":"ObjectCreated:Put","s3":{"bucket":{"name":"lake"},'
        '"object":{"key":"Raw/Local/CSV/Movies/2024/03/20/movies.csv","size":1024}}}]}'
    )
    loc = fx.event_object_location(F.lit(doc))
    row = spark.range(1).select(loc["bucket_name"], loc["object_key"]).first()
    assert tuple(row) == ("lake", "Raw/Local/CSV/Movies/2024/03/20/movies.csv")


def test_pearson_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "x double, y double")
    assert df.agg(op.pearson("x", "y")).first()[0] is None
    fit = op.fit_line(df, "y", "x").first()
    assert fit["corr"] is None and fit["n"] == 3


def test_fit_line_exact(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(10)], "x double, y double")
    fit = op.fit_line(df, "x", "y").first()
    assert (fit["corr"], fit["slope"], fit["intercept"], fit["r2"], fit["n"]) == (1.0, 2.0, 1.0, 1.0, 10)


def _global_numbering(df, cols):
    w = Window.orderBy(*cols)
    return {tuple(r[c] for c in cols): r["id"] for r in df.select(F.row_number().over(w).alias("id"), *cols).collect()}


def test_surrogate_key_matches_global_row_number(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") * 7919 % 5003).alias("k"), F.concat(F.lit("n"), (F.col("id") % 97).cast("string")).alias("name")
    )
    expected = _global_numbering(df, ["k", "name"])
    for parts in (4, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = op.surrogate_key(df, ["k", "name"], "id")
        assert {(r.k, r.name): r.id for r in got.collect()} == expected
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_surrogate_key_strings(spark):
    names = spark.createDataFrame([(f"artist {i:05d}",) for i in range(3000)][::-1], "name string")
    got = op.surrogate_key(names, ["name"], "id")
    ids = {r.name: r.id for r in got.collect()}
    assert ids["artist 00000"] == 1 and ids["artist 02999"] == 3000 and len(set(ids.values())) == 3000


def test_balanced_split_equals_ntile(spark):
    for n_rows, parts in [(205, 3), (200, 3), (7, 10), (101, 101)]:
        df = op.surrogate_key(spark.range(n_rows).withColumnRenamed("id", "k"), ["k"], "rn")
        mine = op.balanced_split(df, "rn", parts)
        nt = mine.withColumn("nt", F.ntile(parts).over(Window.orderBy("rn")))
        assert all(r.part == r.nt for r in nt.collect())
        sizes = [r["count"] for r in mine.groupBy("part").count().collect()]
        assert max(sizes) - min(sizes) <= 1


def test_batch_assign(spark):
    df = op.surrogate_key(spark.range(205).withColumnRenamed("id", "k"), ["k"], "rn")
    sizes = sorted((r.batch, r["count"]) for r in op.batch_assign(df, "rn", 50).groupBy("batch").count().collect())
    assert sizes == [(1, 50), (2, 50), (3, 50), (4, 50), (5, 5)]


def test_top_n_per_group_and_share(spark):
    rows = [("A", i, float(i % 4)) for i in range(30)] + [("B", 100 + i, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, id int, pop double")
    top = op.top_n_per_group(df, ["g"], ["pop", "id"], 10)
    got = top.collect()
    # a hot group never reaches one task whole: each map task keeps at most n rows per group
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sum(1 for r in got if r.g == "A") == 10 and sum(1 for r in got if r.g == "B") == 3
    # ties on pop broken by ascending id
    first_a = sorted((r["rank"], r.id) for r in got if r.g == "A")[:3]
    assert first_a == [(1, 3), (2, 7), (3, 11)]
    sums = spark.createDataFrame([("A", "Q1", 25), ("A", "Q2", 75), ("B", "Q3", 10)], "g string, q string, rev long")
    shares = {(r.g, r.q): r.share_pct for r in op.share_of_total(sums, "rev", ["g"]).collect()}
    assert shares == {("A", "Q1"): 25.0, ("A", "Q2"): 75.0, ("B", "Q3"): 100.0}


def test_counts_and_distincts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "b")], "id int, t string")
    assert op.row_count(df).first()[0] == 4
    assert op.count_distinct(df, "t").first()[0] == 2
    assert op.count_distinct_tuple(df, ["id", "t"]).first()[0] == 3  # null tuple counted
    assert op.drop_duplicates(df).count() == 3
    per = {r.t: r.n_distinct for r in op.group_count_distinct(df, ["t"], "id").collect()}
    assert per == {"a": 1, None: 1, "b": 1}


def test_quality_checks(spark):
    fact = spark.createDataFrame([(1, 10, None), (1, 10, 5.0), (2, 99, 1.0)], "m int, a int, x double")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    actors = spark.createDataFrame([(10,)], "id int")
    assert [tuple(r) for r in op.pk_violations(fact, ["m", "a"]).collect()] == [(1, 10, 2)]
    fk = {r.fk_column: r.n_missing for r in op.fk_violations(fact, [("m", dim, "id"), ("a", actors, "id")]).collect()}
    assert fk == {"m": 0, "a": 1}
    nulls = {r.column_name: r.n_nulls for r in op.null_violations(fact, ["x", "m"]).collect()}
    assert nulls == {"x": 1, "m": 0}
    films = spark.createDataFrame([(1, "A", 2001), (1, "A", 2001), (2, "B", 2002), (2, "B2", 2002)], "id int, t string, y int")
    assert [tuple(r) for r in op.key_consistency(films, "id", ["t", "y"]).collect()] == [(2, 2)]
    prof = {r.column_name: r for r in op.describe_profile(films, ["y"]).collect()}
    assert prof["y"]["count"] == 4 and prof["y"]["min"] == 2001.0 and prof["y"]["max"] == 2002.0


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string").schema
    b = spark.createDataFrame([(1, "x")], "id long, title string").schema
    diffs = op.schema_diff(a, b)
    assert "id: int != bigint" in diffs and "missing column title" in diffs and "unexpected column name" in diffs


def test_wide_lookup_stays_a_shuffle_join(spark, tmp):
    """20 kB names: few rows, but their bytes are over the threshold."""
    fact = spark.range(2000).select((F.col("id") % 500).alias("k"))
    noise = F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.sha2(F.concat_ws("-", "id", i), 256))
    spark.range(500).select(F.col("id").alias("k"), F.concat_ws("", noise).alias("id")).write.parquet(f"{tmp}/dim")
    out = op.lookup_key(fact, spark.read.parquet(f"{tmp}/dim"), "k", "k", "id", "k_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
        assert len(out.collect()) == 2000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" not in plan  # the wide side is not the broadcast one
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_key_join_is_split_by_aqe(spark):
    """One film id holds 40% of the credit rows; the film-side lookup is a shuffle join
    (no broadcast).  AQE must split the hot partition, and no row may be lost."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        credits = spark.range(0, 20000).select(
            F.when(F.col("id") % 10 < 4, F.lit(0)).otherwise(F.col("id") % 997).alias("film"), F.col("id").alias("credit")
        )
        films = spark.range(0, 997).select(F.col("id").alias("film_id"), (F.col("id") * 2).alias("id"))
        out = op.lookup_key(credits, films, "film", "film_id", "id", "film_key")
        assert len(out.collect()) == 20000  # executes this plan, so AQE finalises it
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin" in plan and "skew=true" in plan
        # the fact-build shape: the join feeds a distinct grouped by the join key;
        # build_session forces the split there too (one extra shuffle, only on skew)
        fact = out.select("film", (F.col("credit") % 50).alias("artist")).distinct()
        assert len(fact.collect()) == len({(f, c % 50) for f, c in ((r.film, r.credit) for r in out.collect())})
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_sizing_conf_for_large_inputs():
    from cinelake.session import sizing_conf

    conf = sizing_conf(100 * 1024**4)  # 100 TB
    assert int(conf["spark.sql.shuffle.partitions"]) == 32768  # blocks grow with its square
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(3200 * 1024**2)
    assert conf["spark.sql.files.maxPartitionBytes"] == str(1024**3)
    assert sizing_conf(1024**4)["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * 1024**2)
    assert int(sizing_conf(10)["spark.sql.shuffle.partitions"]) == 200


def test_degenerate_arguments(spark):
    df = spark.createDataFrame([(1, "Sci-Fi", 0)], "id int, g string, v int")
    assert op.filter_like_any(df, "g", []).count() == 0
    assert op.filter_tag_token(df, "g", []).count() == 0
    assert op.filter_nonzero(df, []).count() == 1
    assert df.select(fx.label_codes("id", {}).alias("x")).first().x is None


def test_numbering_has_one_path_and_no_single_task(spark):
    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 3001).alias("k"), F.repeat(F.lit("x"), 500).alias("wide"))
    expected = _global_numbering(df, ["k"])
    got, total = op.surrogate_key_counted(df, ["k"], "id")
    assert total == 3000 and {(r.k,): r.id for r in got.collect()} == expected
    empty, none = op.surrogate_key_counted(df.filter("k < 0"), ["k"], "id")
    assert none == 0 and empty.count() == 0 and empty.columns == ["id", "k", "wide"]


def test_pearson_is_pairwise_complete(spark):
    rows = [(float(i), 3.0 * i + (i % 3)) for i in range(50)]
    holes = rows + [(None, 1e9), (1e9, None), (None, None)]
    a = spark.createDataFrame(rows, "x double, y double").agg(F.round(op.pearson("x", "y"), 9)).first()[0]
    assert spark.createDataFrame(holes, "x double, y double").agg(F.round(op.pearson("x", "y"), 9)).first()[0] == a > 0.99


def test_event_document_without_records(spark):
    docs = spark.createDataFrame([('{"Records":[]}',), ("{}",), ("no json",), (None,)], "doc string")
    loc = fx.event_object_location("doc")
    assert [tuple(r) for r in docs.select(loc["bucket_name"], loc["object_key"]).collect()] == [(None, None)] * 4


def test_profile_covers_texts_and_dates(spark):
    import datetime as dt

    df = spark.createDataFrame([(1.0, "b", dt.date(2024, 1, 2)), (3.0, "a", None), (None, None, None)], "x double, s string, d date")
    got = {r.column_name: r for r in op.describe_profile(df).collect()}
    assert (got["x"]["count"], got["x"]["mean"], got["x"].min_text) == (2, 2.0, None)
    assert (got["s"]["count"], got["s"].min_text, got["s"].max_text, got["s"]["mean"]) == (2, "a", "b", None)
    assert (got["d"]["count"], got["d"].min_text) == (1, "2024-01-02")


def test_no_action_runs_while_a_check_is_planned(spark):
    def boom(batches):
        raise RuntimeError("ran")

    fact = spark.range(5).select(F.col("id").alias("fk"))
    dim = spark.range(3).mapInArrow(boom, "id long")
    op.fk_violations(fact, [("fk", dim, "id")])
    op.lookup_key(fact, dim.withColumnRenamed("id", "k"), "fk", "k", "k", "out")


def test_sorts_come_out_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"), F.col("id").alias("v")).repartition(7)
    assert [r.k for r in op.sort_asc(df, ["k", "v"]).collect()] == sorted(r.k for r in df.collect())
    down = [(r.k, r.v) for r in op.sort_desc(df.withColumn("k", F.col("k") % 10), "k", ["v"]).collect()]
    assert down == sorted(down, key=lambda t: (-t[0], t[1]))


def test_stage_counts(spark):
    df = spark.range(10)
    got = op.stage_counts([("all", df), ("some", df.filter("id > 6")), ("none", df.filter("id > 60"))]).collect()
    assert [tuple(r) for r in sorted(got)] == [(1, "all", 10), (2, "some", 3), (3, "none", 0)]


def test_sketches_of_partitions_add_up(spark, tmp):
    from cinelake import operators as op

    rows = spark.range(20_000).selectExpr("cast(id % 4 as int) AS year", "id % 2 AS side", "id % 5000 AS v")
    table = op.SketchTable(spark, tmp, "year", ["side"])
    for year in (0, 1, 2, 3):
        table.add(rows.filter(f"year = {year}"), "v")
        exact = rows.filter(f"year <= {year}").select("v").distinct().count()
        assert abs(table.estimate().first().n_distinct - exact) <= 4 * table.error * exact + 1
    before = table.estimate().first().n_distinct
    table.add(rows.filter("year = 1"), "v")  # the same partition again
    assert table.estimate().first().n_distinct == before
    assert {r.year for r in table.estimate(["year"]).collect()} == {0, 1, 2, 3}
    assert {r.side for r in table.estimate(["side"]).collect()} == {0, 1}

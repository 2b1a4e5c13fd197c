"""Trusted layer, enrichment and star schema on fixture rows (FIXTURES.md §1, §2, §6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinelake import operators as op
from cinelake.plans import analytics as an
from cinelake.plans import enrich as en
from cinelake.plans import star as st
from cinelake.plans import trusted as tr
from cinelake.sources import RAW_CREDITS_DDL, RAW_DETAILS_SCHEMA


def credit(id_, genero="Action,Sci-Fi", votes=100, role="Hero", artist="Ann", minutes=90, prof="actress", rating=7.0):
    return (id_, f"T{id_}", f"O{id_}", 2001, minutes, genero, rating, votes, "x", role, artist, 1970, None, prof, "tt9")


@pytest.fixture()
def raw_credits(spark):
    rows = [
        credit("tt1"),  # plain, class 2
        credit("tt2", genero="Fantasy,Sci-Fi", artist="Bob"),  # both tags, class 3
        credit("tt3", genero="Drama"),  # dropped by the tag filter
        credit("tt4", genero="Science Fantasyland", artist="Cid"),  # passes LIKE
        credit("tt5", artist="Dee"),
        credit("tt5", artist="Dee"),  # exact duplicate
        credit("tt5", artist="Eve", prof="a"),
        credit("tt5", artist="Eve", prof="b"),  # duplicate once profissao is dropped
        credit("tt6", minutes=None, artist="Fay"),  # \N in INT: null then dropped
        credit("tt7", role="\\N", artist="Gus"),  # role sentinel: kept, role null
        credit("tt8", role=None, artist="Hal"),  # empty role: dropped
        credit("tt9", votes=29, artist="Ivy"),  # below vote minimum
        credit("tt10", votes=30, artist="Jon"),  # at the minimum
        credit("tt1", role="Villain"),  # two roles, same film and artist
        credit("tt11", genero="Fantasy", artist="Kim"),  # film without details
        credit("tt12", genero="Fantasy", artist="Ann"),  # homonym artist name
    ]
    return spark.createDataFrame(rows, RAW_CREDITS_DDL)


def detail(id_, imdb, date="2005-05-17", budget=10, revenue=100, runtime=90, votes=50, pop=5.0, genres=None):
    return (id_, imdb, f"T{imdb}", date, 7.0, votes, pop, budget, revenue, runtime, genres or [(1, "Adventure")])


@pytest.fixture()
def raw_details(spark):
    rows = [
        detail(1, "tt1"),
        detail(2, "tt2", date="2005-11-02", pop=9.0, revenue=300),
        detail(4, "tt4", date="2010-01-05", revenue=200),
        detail(5, "tt5", date="2010-04-05", revenue=50),
        detail(5, "tt5", date="2010-04-05", revenue=50),  # exact duplicate
        detail(7, "tt7", date="", revenue=70),  # empty date -> null
        detail(10, "tt10", date="2012-07-07", revenue=80),
        detail(12, "tt12", date="2012-12-12", revenue=90),
        detail(13, "tt13", budget=0),  # zero measure
        detail(14, "tt14", runtime=None),  # null measure
        detail(15, "tt15", votes=29),  # below vote minimum
        detail(16, "tt16", revenue=2_900_000_000),  # wide money
        detail(17, "tt17", genres=[(1, "A")]),
        detail(17, "tt17", genres=[(2, "B")]),  # differs only in genres
    ]
    return spark.createDataFrame(rows, RAW_DETAILS_SCHEMA)


def test_trusted_credits(raw_credits):
    out = tr.trusted_credits(raw_credits)
    assert "tituloPrincipal" in out.columns and "profissao" not in out.columns
    rows = out.collect()
    ids = sorted(r.id for r in rows)
    assert ids == ["tt1", "tt1", "tt10", "tt11", "tt12", "tt2", "tt4", "tt5", "tt5", "tt7"]
    assert [r.personagem for r in rows if r.id == "tt7"] == [None]


def test_trusted_details(raw_details):
    out = tr.trusted_details(raw_details, extraction_date=dt.date(2024, 3, 27))
    got = {}
    for r in out.collect():
        got.setdefault(r.imdb_id, []).append(r)
    assert sorted(got) == ["tt1", "tt10", "tt12", "tt16", "tt17", "tt2", "tt4", "tt5", "tt7"]
    assert len(got["tt5"]) == 1 and len(got["tt17"]) == 2  # de-dup happens before genres are dropped
    assert got["tt7"][0].release_date is None
    assert got["tt16"][0].revenue == 2_900_000_000
    assert {r.extraction_date for rs in got.values() for r in rs} == {dt.date(2024, 3, 27)}


def test_trusted_details_date_from_path(spark, raw_details):
    df = raw_details.withColumn("src", F.lit("s3://lake/Raw/TMDB/JSON/2024/03/27/details-part-0.json"))
    out = tr.trusted_details(df, path_col="src")
    assert {r.extraction_date for r in out.collect()} == {dt.date(2024, 3, 27)}


def test_candidates_and_enrichment(spark, raw_credits, raw_details):
    cands = tr.candidate_ids(raw_credits)
    ids = sorted(r.id for r in cands.collect())
    assert "tt4" not in ids and "tt3" not in ids and "tt11" in ids  # exact tokens only
    marked = en.mark_found(cands, raw_details, "id", "imdb_id")
    found = {r.id: r.found for r in marked.collect()}
    assert found["tt1"] and not found["tt11"]
    rate = en.enrichment_rate(cands, raw_details, "id", "imdb_id").first()
    assert rate.n_found + rate.n_missing == rate.n_requested == len(ids)
    assert rate.success_pct == round(100.0 * rate.n_found / rate.n_requested, 2)
    missing = {r.id for r in op.ids_missing(cands, raw_details, "id", "imdb_id").collect()}
    assert missing == {i for i, f in found.items() if not f}


@pytest.fixture()
def star(raw_credits, raw_details):
    return st.build_star(tr.trusted_credits(raw_credits), tr.trusted_details(raw_details, extraction_date=dt.date(2024, 3, 27)))


def test_star_tables(star):
    actors = {r.name: (r.id, r.num_movies) for r in star.dim_actor.collect()}
    assert actors["Kim"][1] == 1  # artist only in a film without details stays in dim_actor
    assert actors["Ann"][1] == 3  # homonyms collapse; counts credit rows
    assert sorted(a[0] for a in actors.values()) == list(range(1, len(actors) + 1))
    dates = star.dim_date.orderBy("id").collect()
    assert dates[0].date == dt.date(2005, 5, 17) and dates[0].quarter == "Q2" and dates[0].id == 1
    assert all(d.date is not None for d in dates)
    fact = star.fact.collect()
    assert {r.id_movie for r in fact} == {"tt1", "tt2", "tt4", "tt5", "tt10", "tt12"}  # tt7 has no date, tt11 no details
    assert sorted(r.actor_role for r in fact if r.id_movie == "tt1") == ["Hero", "Villain"]
    genres = {r.id: (r.genre, r.num_movies) for r in star.dim_genre.collect()}
    assert genres[3] == ("Fantasy/Sci-Fi", 1) and genres[2][0] == "Sci-Fi"
    assert op.pk_violations(star.fact, ["id_movie", "id_actor", "id_date", "id_genre"]).count() == 1
    fks = op.fk_violations(
        star.fact,
        [("id_movie", star.dim_movie, "id"), ("id_actor", star.dim_actor, "id"), ("id_date", star.dim_date, "id"), ("id_genre", star.dim_genre, "id")],
    )
    assert all(r.n_missing == 0 for r in fks.collect())


def test_star_ids_stable_across_partitioning(spark, raw_credits, raw_details):
    def ids(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        s = st.build_star(tr.trusted_credits(raw_credits), tr.trusted_details(raw_details, extraction_date=dt.date(2024, 3, 27)))
        return sorted(tuple(r) for r in s.fact.collect()), sorted(tuple(r) for r in s.dim_actor.collect())

    try:
        assert ids(4) == ids(7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_analyses(star):
    shares = an.seasonal_share(star).collect()
    per_genre = {}
    for r in shares:
        per_genre[r.genre] = per_genre.get(r.genre, 0.0) + r.share_pct
    assert all(abs(v - 100.0) < 0.05 for v in per_genre.values())
    flat = st.star_flatten(star)
    assert flat.count() == star.fact.count()
    assert {"genre_num_movies", "actor_num_movies", "name", "year"} <= set(flat.columns)
    fits = {r.grain: r for r in an.budget_revenue_fit(star).collect()}
    assert fits["fact"].n == star.fact.count()
    assert fits["film"].n == star.fact.select("id_movie").distinct().count()
    top = an.top_popular_per_genre(star, 1).collect()
    assert len(top) == star.dim_genre.count()
    rec = {r.id_actor: r.recurrence for r in an.artist_recurrence(star).collect()}
    assert max(rec.values()) <= 1.0


def test_write_and_register_star(spark, star, tmp):
    from cinelake.sources import register_tables

    root = f"{tmp}/refined"
    folder = st.write_star(star, root)
    back = st.read_star(spark, root)
    assert sorted(map(tuple, back.fact.select(*st.FACT_COLUMNS).collect())) == sorted(map(tuple, star.fact.collect()))
    assert back.dim_actor.count() == star.dim_actor.count()
    years = {r.release_year for r in spark.read.parquet(f"{folder}/fact_movie_actor").select("release_year").collect()}
    assert years == {2005, 2010, 2012}  # one folder per release year, not per film
    names = register_tables(spark, folder, ["dim_genre", "dim_actor"])
    assert spark.sql(f"SELECT count(*) FROM {names[0]}").first()[0] == 3
    spark.sql("DROP TABLE IF EXISTS dim_genre")
    spark.sql("DROP TABLE IF EXISTS dim_actor")


def test_a_rebuild_replaces_the_star_whole(spark, raw_credits, raw_details, tmp):
    """The second build has fewer films, so other ids and years: nothing of the first is left,
    and a build that broke off before its last step is not seen."""
    from cinelake import operators as op

    tc = tr.trusted_credits(raw_credits)
    td = tr.trusted_details(raw_details, extraction_date=dt.date(2024, 3, 27))
    root = f"{tmp}/refined"
    st.write_star(st.build_star(tc, td), root)
    first = st.read_star(spark, root)
    newest = td.agg({"release_date": "max"}).first()[0]
    fewer = st.build_star(tc.filter("id <> 'tt1'"), td.filter(td.release_date == newest))
    st.write_star(fewer, root)
    back = st.read_star(spark, root)
    assert 0 < back.fact.count() == fewer.fact.count() < first.fact.count()
    refs = [("id_movie", back.dim_movie, "id"), ("id_actor", back.dim_actor, "id"), ("id_date", back.dim_date, "id"), ("id_genre", back.dim_genre, "id")]
    assert {r.n_missing for r in op.fk_violations(back.fact, refs).collect()} == {0}
    first.dim_actor.write.parquet(f"{root}/build-99999999999999999999-broken/dim_actor")
    assert st.read_star(spark, root).fact.count() == fewer.fact.count()
    st.drop_old_builds(spark, root)
    assert st.read_star(spark, root).fact.count() == fewer.fact.count()
    with pytest.raises(Exception):
        first.fact.count()


def test_two_snapshots_of_a_film_count_once(spark, raw_credits, raw_details):
    from pyspark.sql import functions as F

    tc = tr.trusted_credits(raw_credits)
    one = tr.trusted_details(raw_details, extraction_date=dt.date(2024, 3, 27))
    two = one.withColumn("extraction_date", F.lit(dt.date(2024, 4, 1))).withColumn("popularity", F.col("popularity") + 5)
    single, double = st.build_star(tc, two), st.build_star(tc, one.unionByName(two))
    for fn in (an.releases_per_year, an.popularity_per_year, an.seasonal_share, an.rating_by_genre, an.top_artists_revenue):
        assert sorted(map(tuple, fn(double).collect()), key=str) == sorted(map(tuple, fn(single).collect()), key=str)
    assert double.dim_movie.count() == single.dim_movie.count()


def test_bucketed_star_joins_without_shuffle(spark, star, tmp):
    tables = st.write_star_bucketed(star, f"{tmp}/bucketed", prefix="t_", n_buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, movies = spark.table(tables["fact_movie_actor"]), spark.table(tables["dim_movie"])
        joined = fact.join(movies, fact["id_movie"] == movies["id"], "left")
        assert joined.count() == star.fact.count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan  # co-located: no shuffle
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for t in tables.values():
            spark.sql(f"DROP TABLE IF EXISTS {t}")

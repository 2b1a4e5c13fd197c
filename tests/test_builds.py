"""Builds that are audited before they are published, ids that stay over builds, counts taken while
a table is written, and rejected records."""

import datetime as dt
import os

import pytest

from cinelake import jobs
from cinelake import operators as op
from cinelake.plans import analytics, star
from cinelake.sources import read_checked
from tests.test_jobs import HEADER, detail, line, write


def small_star(spark, credits, details):
    c = spark.createDataFrame(
        [(i, f"T{i}", f"O{i}", 2001, 90, tags, 7.0, 100, role, artist) for i, tags, role, artist in credits],
        "id string, tituloPrincipal string, tituloOriginal string, anoLancamento int, tempoMinutos int, genero string, notaMedia double, "
        "numeroVotos int, personagem string, nomeArtista string",
    )
    d = spark.createDataFrame(
        [(n, i, i, day, 7.0, 50, 1.0, 10, money, 90) for n, (i, day, money) in enumerate(details)],
        "id long, imdb_id string, title string, release_date date, vote_average double, vote_count long, popularity double, budget long, revenue long, runtime long",
    )
    return star.build_star(c, d)


DAY = dt.date(2005, 5, 17)


def test_a_film_with_two_tag_strings_counts_once(spark):
    s = small_star(spark, [("a", "Fantasy", "x", "Ann"), ("a", "Fantasy,Sci-Fi", "y", "Bob"), ("b", "Sci-Fi", "z", "Ann")], [("a", DAY, 100), ("b", DAY, 7)])
    assert [tuple(r) for r in analytics.releases_per_year(s).collect()] == [(2005, 2)]
    assert analytics.budget_revenue_per_year(s, 2000, 2010).first().total_revenue == 107
    assert analytics.popularity_per_year(s).first().releases == 2
    assert {(r.grain, r.n) for r in analytics.budget_revenue_fit(s).collect()} == {("fact", 3), ("film", 2)}
    assert {r.genre: r.films for r in analytics.rating_by_genre(s).collect()} == {"Fantasy": 1, "Fantasy/Sci-Fi": 1, "Sci-Fi": 1}


def test_a_build_with_a_missing_key_stays_unpublished(spark, tmp):
    good = small_star(spark, [("a", "Fantasy", "x", "Ann"), ("a", "Fantasy", "y", "Ann"), ("b", "Sci-Fi", None, "Bob")], [("a", DAY, 1), ("b", DAY, 2)])
    first = star.write_star(good, tmp)
    found = {(r.check_name, r.what): r.n_violations for r in spark.read.parquet(f"{first}/audit").collect()}
    assert found["declared key", "id_movie,id_actor,id_date,id_genre"] == 1 and sum(found.values()) == 1
    holes = star.Star(good.dim_actor.filter("name <> 'Bob'"), good.dim_date, good.dim_movie, good.fact, good.dim_genre)
    with pytest.raises(star.AuditFailed, match="foreign key id_actor: 1") as failed:
        star.write_star(holes, tmp)
    assert star.current_build(spark, tmp) == first
    assert spark.read.parquet(f"{failed.value.folder}/audit").filter("n_violations > 0").count() == 2
    star.drop_old_builds(spark, tmp)  # neither the current nor an unpublished one
    assert os.path.exists(first) and os.path.exists(failed.value.folder)
    second = star.write_star(good, tmp)
    star.drop_old_builds(spark, tmp)
    assert not os.path.exists(first) and star.current_build(spark, tmp) == second


def test_audit_is_one_pass_and_holds_for_empty_tables(spark):
    fact = spark.createDataFrame([(1, 1, None), (1, 1, 2), (2, 9, 3)], "a int, b int, c int")
    dim = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    df = op.audit(fact, ["c"], [("b", dim, "id")], ["a", "b", "c"], ["a", "b"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [a#") == 1
    found = {r.check_name: (r.n_violations, r.blocks) for r in df.collect()}
    assert found == {"foreign key": (1, True), "not null": (1, True), "primary key": (0, True), "declared key": (1, False)}
    empty = op.audit(fact.limit(0), ["c"], [("b", dim, "id")], ["a"])
    assert {r.n_violations for r in empty.collect()} == {0}


def test_keys_go_on_and_stay(spark, tmp):
    def names(*rows):
        return spark.createDataFrame([(r,) for r in rows], "name string")

    keys = op.KeyRegistry(spark, tmp)
    assert keys.assign(names().limit(0), ["name"]).count() == 0
    first = {r.name: r.id for r in keys.assign(names("b", "d", "d", None), ["name"]).collect()}
    assert first == {"b": 1, "d": 2}
    second = {r.name: r.id for r in op.KeyRegistry(spark, tmp).assign(names("a", "d", "c"), ["name"]).collect()}
    assert second == {"a": 3, "c": 4, "d": 2}
    assert {r.name: r.id for r in keys.assign(names("b"), ["name"]).collect()} == {"b": 1}
    assert keys.ids().count() == 4


def test_refined_ids_stay_over_builds(spark, tmp):
    def build(*artists):
        rows = [line(f"tt{i}", "Fantasy", artist=a) for i, a in enumerate(artists)]
        write(f"{tmp}/raw{len(artists)}/movies.csv", HEADER + "\n" + "\n".join(rows) + "\n")
        import json

        details = [json.dumps(detail(i + 1, f"tt{i}", f"20{20 - i}-05-17")) for i in range(len(artists))]
        write(f"{tmp}/json/2024/03/27/a.json", "\n".join(details) + "\n")
        jobs.trusted_credits_job(spark, f"{tmp}/raw{len(artists)}", f"{tmp}/tc", mode="overwrite")
        jobs.trusted_details_job(spark, f"{tmp}/json", f"{tmp}/td")
        s = jobs.refined_job(spark, f"{tmp}/tc", f"{tmp}/td", f"{tmp}/ref")
        return {r.name: r.id for r in s.dim_actor.collect()}, {r.year: r.id for r in s.dim_date.collect()}

    actors, dates = build("Cid", "Eve")
    more, later = build("Cid", "Eve", "Ann", "Dan")
    assert {n: more[n] for n in actors} == actors and {y: later[y] for y in dates} == dates
    assert sorted(more.values()) == [1, 2, 3, 4] and sorted(later.values()) == [1, 2, 3, 4]


def test_details_report_counts_every_stage_while_writing(spark, tmp):
    import json

    rows = [detail(1, "tt1", "2005-05-17"), detail(1, "tt1", "2005-05-17"), detail(2, "tt2", "2006-01-02", revenue=0), detail(3, "tt3", "")]
    write(f"{tmp}/json/2024/03/27/a.json", "\n".join(json.dumps(r) for r in rows) + "\n")
    jobs.trusted_details_job(spark, f"{tmp}/json", f"{tmp}/td", report=f"{tmp}/report")
    funnel = spark.read.parquet(f"{tmp}/report/funnel").orderBy("stage_no").collect()
    assert [(r.stage, r.n_rows) for r in funnel] == [("raw", 4), ("dedup", 3), ("nonzero", 2), ("min_votes", 2)]
    assert spark.read.parquet(f"{tmp}/report/profile").filter("column_name = 'revenue'").first().max_text == "100"


def test_profile_keeps_all_digits(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, "x"), (5, None)], "n long, `a.b` string")
    got = {r.column_name: r for r in op.describe_profile(df).collect()}
    assert (got["n"].min_text, got["n"].max_text) == ("5", str(big)) and got["a.b"].max_text == "x"


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_rejected_records(spark, tmp, fmt):
    if fmt == "csv":
        write(f"{tmp}/in/a.csv", "id|n\na|1\nb|x\nc|2|3\nd\ne|\n")
        write(f"{tmp}/in/b.csv", "id|n\nf|7\n")
        bad = {"b|x", "c|2|3", "d"}
    else:
        write(f"{tmp}/in/a.json", '{"id": "a", "n": 1}\n{"id": "b", "n": "x"}\n{"id": broken\n{"id": "e"}\n')
        write(f"{tmp}/in/b.json", '{"id": "f", "n": 7}\n')
        bad = {'{"id": "b", "n": "x"}', '{"id": broken'}
    accepted, rejected = read_checked(spark, f"{tmp}/in", "id string, n int", fmt)
    assert sorted((r.id, r.n) for r in accepted.collect()) == [("a", 1), ("e", None), ("f", 7)]
    got = rejected.collect()
    assert {r.record for r in got} == bad and {os.path.basename(r.source_file) for r in got} == {f"a.{fmt}"}
    assert len({(r.source_file, r.split_start, r.split_row) for r in got}) == len(got)

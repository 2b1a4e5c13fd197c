"""The batch jobs end to end on landed fixture files: raw CSV + JSON -> trusted ->
refined star -> error list, with the layer rules checked on the written output."""

import datetime as dt
import glob
import json
import os

from cinelake import jobs
from cinelake import operators as op
from cinelake.plans import star

HEADER = (
    "id|tituloPincipal|tituloOriginal|anoLancamento|tempoMinutos|genero|notaMedia|numeroVotos|generoArtista|"
    "personagem|nomeArtista|anoNascimento|anoFalecimento|profissao|titulosMaisConhecidos"
)


def line(id_, genero, votes=100, role="Hero", artist="Ann"):
    return f"{id_}|T{id_}|O{id_}|2001|90|{genero}|7.0|{votes}|actor|{role}|{artist}|1970|\\N|actor|tt9"


def detail(i, imdb, date, revenue=100):
    return {"id": i, "imdb_id": imdb, "title": imdb, "release_date": date, "vote_average": 7.0, "vote_count": 50,
            "popularity": float(i), "budget": 10 * i, "revenue": revenue, "runtime": 90, "genres": [{"id": 1, "name": "x"}]}


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_jobs_end_to_end(spark, tmp):
    raw_csv = f"{tmp}/Raw/Local/CSV/Movies/2024/03/20/movies.csv"
    rows = [line("tt1", "Action,Sci-Fi"), line("tt2", "Fantasy", artist="Bob"), line("tt3", "Drama"),
            line("tt4", "Fantasy,Sci-Fi", role="\\N", artist="Cid"), line("tt5", "Fantasy", votes=10)]
    write(raw_csv, HEADER + "\n" + "\n".join(rows) + "\n")
    write(f"{tmp}/Raw/TMDB/JSON/2024/03/27/details-part-0.json",
          "\n".join(json.dumps(d) for d in [detail(1, "tt1", "2005-05-17"), detail(2, "tt2", "2010-11-02")]) + "\n")
    write(f"{tmp}/Raw/TMDB/JSON/2024/03/28/details-part-0.json", json.dumps(detail(4, "tt4", "2012-04-01", 300)) + "\n")

    tc = jobs.trusted_credits_job(spark, f"{tmp}/Raw/Local/CSV", f"{tmp}/Trusted/CSV")
    assert sorted(r.id for r in tc.collect()) == ["tt1", "tt2", "tt4"]
    td = jobs.trusted_details_job(spark, f"{tmp}/Raw/TMDB/JSON", f"{tmp}/Trusted/TMDB")
    assert {(r.imdb_id, r.extraction_date) for r in td.collect()} == {
        ("tt1", dt.date(2024, 3, 27)), ("tt2", dt.date(2024, 3, 27)), ("tt4", dt.date(2024, 3, 28))
    }
    # re-running the details job replaces its dates instead of appending
    td = jobs.trusted_details_job(spark, f"{tmp}/Raw/TMDB/JSON", f"{tmp}/Trusted/TMDB")
    assert td.count() == 3

    s = jobs.refined_job(spark, f"{tmp}/Trusted/CSV", f"{tmp}/Trusted/TMDB", f"{tmp}/Refined")
    assert s.fact.count() == 3
    assert {r.genre: r.num_movies for r in s.dim_genre.collect()} == {"Sci-Fi": 1, "Fantasy": 1, "Fantasy/Sci-Fi": 1}
    assert op.null_violations(s.fact, ["runtime", "revenue", "budget"]).filter("n_nulls > 0").count() == 0

    stats = jobs.enrichment_job(spark, f"{tmp}/Raw/Local/CSV", f"{tmp}/Raw/TMDB/JSON", f"{tmp}/errors")
    assert (stats["n_requested"], stats["n_found"], stats["n_missing"]) == (4, 3, 1)
    errors = "".join(open(f).read() for f in glob.glob(f"{tmp}/errors/*.csv")).split()
    assert errors == ["tt5"]


def test_refined_job_rejects_wrong_trusted_schema(spark, tmp):
    import pytest

    bad = spark.createDataFrame([("tt1", "x")], "id string, nomeArtista string")
    bad.write.parquet(f"{tmp}/credits")
    spark.createDataFrame([(1,)], "id long").write.parquet(f"{tmp}/details")
    with pytest.raises(ValueError, match="missing column numeroVotos"):
        jobs.refined_job(spark, f"{tmp}/credits", f"{tmp}/details", f"{tmp}/refined")


def test_cli_entry_points(spark, tmp, capsys):
    write(f"{tmp}/raw/movies.csv", HEADER + "\n" + "\n".join([line("tt1", "Action,Sci-Fi"), line("tt2", "Drama")]) + "\n")
    write(f"{tmp}/json/2024/03/27/details-part-0.json", json.dumps(detail(1, "tt1", "2005-05-17")) + "\n")
    jobs.main(["trusted-credits", "--input", f"{tmp}/raw", "--output", f"{tmp}/tc"])
    jobs.main(["trusted-details", "--input", f"{tmp}/json", "--output", f"{tmp}/td"])
    jobs.main(["refined", "--credits", f"{tmp}/tc", "--details", f"{tmp}/td", "--output", f"{tmp}/ref"])
    jobs.main(["enrichment", "--credits", f"{tmp}/raw", "--details", f"{tmp}/json", "--errors", f"{tmp}/err"])
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (stats["n_requested"], stats["n_found"]) == (1, 1)
    assert star.read_star(spark, f"{tmp}/ref").fact.count() == 1


def test_refined_job_bucketed(spark, tmp):
    write(f"{tmp}/raw/movies.csv", HEADER + "\n" + "\n".join([line("tt1", "Action,Sci-Fi"), line("tt2", "Fantasy", artist="Bob")]) + "\n")
    write(f"{tmp}/json/2024/03/27/details-part-0.json",
          "\n".join(json.dumps(d) for d in [detail(1, "tt1", "2005-05-17"), detail(2, "tt2", "2006-01-02")]) + "\n")
    jobs.trusted_credits_job(spark, f"{tmp}/raw", f"{tmp}/tc")
    jobs.trusted_details_job(spark, f"{tmp}/json", f"{tmp}/td")
    s = jobs.refined_job(spark, f"{tmp}/tc", f"{tmp}/td", f"{tmp}/ref", bucketed=True)
    try:
        assert s.fact.count() == 2 and s.dim_movie.count() == 2
    finally:
        for t in ("fact_movie_actor", "dim_movie", "dim_actor", "dim_date", "dim_genre"):
            spark.sql(f"DROP TABLE IF EXISTS refined_{t}")


def test_landing_report_found_analysis_and_catalogue(spark, tmp, capsys):
    rows = [line("tt1", "Action,Sci-Fi"), line("tt2", "Fantasy", artist="Bob"), line("tt9", "Fantasy", role='a "q" \\ , b')]
    write(f"{tmp}/in/movies.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    write(f"{tmp}/in/skip.txt", "x")
    args = ["land", "--input", f"{tmp}/in", "--output", f"{tmp}/lake", "--day", "2024-03-20"]
    jobs.main(args)
    landed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(landed) == 1 and "Movies/2024/03/20" in landed[0]
    jobs.main(args)  # there already
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == []

    write(f"{tmp}/json/2024/03/27/a.json", "\n".join(json.dumps(d) for d in [detail(1, "tt1", "2005-05-17"), detail(2, "tt2", "2006-01-02"), detail(3, "tt3", "2006-01-02")]) + "\n")
    assert [r.value for r in spark.read.text(landed[0]).collect()] == [HEADER, *rows]
    jobs.main(["trusted-credits", "--input", f"{tmp}/lake/Raw", "--output", f"{tmp}/tc", "--report", f"{tmp}/report"])
    assert {r.stage: r.n_rows for r in spark.read.parquet(f"{tmp}/report/counts").collect()} == {"raw": 3, "trusted": 3}
    profile = {r.column_name: r for r in spark.read.parquet(f"{tmp}/report/profile").collect()}
    assert profile["id"].min_text == "tt1" and profile["numeroVotos"]["mean"] == 100.0
    jobs.main(["enrichment", "--credits", f"{tmp}/lake/Raw", "--details", f"{tmp}/json", "--errors", f"{tmp}/err", "--found", f"{tmp}/found"])
    found = spark.read.json(f"{tmp}/found")
    assert sorted(r.imdb_id for r in found.collect()) == ["tt1", "tt2"]

    jobs.main(["trusted-details", "--input", f"{tmp}/json", "--output", f"{tmp}/td"])
    jobs.main(["refined", "--credits", f"{tmp}/tc", "--details", f"{tmp}/td", "--output", f"{tmp}/ref"])
    jobs.main(["analysis", "--refined", f"{tmp}/ref", "--output", f"{tmp}/results"])
    assert sum(r.releases for r in spark.read.parquet(f"{tmp}/results/releases_per_year").collect()) == 2
    assert set(jobs.ANALYSES) == set(os.listdir(f"{tmp}/results"))
    tables = ["fact_movie_actor", "dim_movie", "dim_actor", "dim_date", "dim_genre"]
    try:
        jobs.main(["catalogue", "--refined", f"{tmp}/ref"])
        open_query = spark.sql("SELECT * FROM fact_movie_actor")
        assert open_query.count() == 2
        # the next build takes the view's place; who still reads the old one can finish
        jobs.main(["refined", "--credits", f"{tmp}/tc", "--details", f"{tmp}/td", "--output", f"{tmp}/ref"])
        jobs.main(["catalogue", "--refined", f"{tmp}/ref"])
        assert spark.sql("SELECT count(*) FROM fact_movie_actor").first()[0] == 2 == open_query.count()
        held = [t.name for t in spark.catalog.listTables() if t.name.startswith("fact_movie_actor__")]
        assert len(held) == 2
        jobs.main(["catalogue", "--refined", f"{tmp}/ref", "--clean"])
        left = [t.name for t in spark.catalog.listTables() if t.name.startswith("fact_movie_actor__")]
        assert len(left) == 1
        stats = spark.sql(f"DESCRIBE EXTENDED {left[0]} id_movie").collect()
        assert {r.info_name: r.info_value for r in stats}["distinct_count"] == "2"
    finally:
        for t in tables:
            spark.sql(f"DROP VIEW IF EXISTS {t}")
        for t in spark.catalog.listTables():
            if "__build_" in t.name:
                spark.sql(f"DROP TABLE IF EXISTS {t.name}")

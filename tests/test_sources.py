"""Readers and sinks on small fixtures (FIXTURES.md §1, §2, §4, §5)."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from cinelake.sources import (
    RAW_CREDITS_DDL,
    RAW_DETAILS_SCHEMA,
    landing_inventory,
    read_delimited,
    read_json_lines,
    write_id_list,
    write_json_balanced,
    write_parquet,
)

HEADER = (
    "id|tituloPincipal|tituloOriginal|anoLancamento|tempoMinutos|genero|notaMedia|numeroVotos|generoArtista|"
    "personagem|nomeArtista|anoNascimento|anoFalecimento|profissao|titulosMaisConhecidos"
)


def write_text(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_delimited_scan_edge_cases(spark, tmp):
    rows = [
        'tt1|"D|E"|Orig|2001|90|Action,Sci-Fi|7.5|100|actor|Hero|Ann|1970|\\N|actress|tt9',
        "tt2|B|B|\\N|80|Drama|6.0|50|actor|\\N|Bob|1960|\\N|actor|tt8",
        "tt3|C|C|1999|70|Fantasy",  # short row: null padded
        "tt4|D|D|1998|60|Fantasy|5.0|40|actor|Role|Cid|1950|2000|actor|tt7|extra",  # extra field dropped
    ]
    write_text(tmp, "movies.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    write_text(tmp, "notes.txt", "not,a,csv\n")  # skipped by the glob
    df = read_delimited(spark, tmp, RAW_CREDITS_DDL)
    got = {r["id"]: r for r in df.collect()}
    assert set(got) == {"tt1", "tt2", "tt3", "tt4"}
    assert got["tt1"]["tituloPincipal"] == "D|E"  # quoted separator kept
    assert got["tt2"]["anoLancamento"] is None  # \N in an INT column
    assert got["tt2"]["personagem"] == "\\N"  # \N survives as text in a string column
    assert got["tt3"]["notaMedia"] is None and got["tt3"]["titulosMaisConhecidos"] is None
    assert got["tt4"]["titulosMaisConhecidos"] == "tt7"


def test_json_lines_fixed_schema(spark, tmp):
    folder = os.path.join(tmp, "Raw", "TMDB", "JSON", "2024", "03", "27")
    recs = [
        {"id": 1, "imdb_id": "tt1", "title": "A", "release_date": "2005-05-17", "vote_average": 7.4,
         "vote_count": 50, "popularity": 4.0, "budget": 10, "revenue": 2900000000, "runtime": 140,
         "genres": [{"id": 12, "name": "Adventure"}], "unknown": "x"},
        {"id": 2, "imdb_id": "tt2", "title": "B", "release_date": "", "vote_average": 6.0,
         "vote_count": 30, "popularity": 1.0, "budget": 5, "runtime": 90, "genres": []},
    ]
    write_text(folder, "details-part-0.json", "\n".join(json.dumps(r) for r in recs) + "\n")
    df = read_json_lines(spark, os.path.join(tmp, "Raw"), RAW_DETAILS_SCHEMA, with_source=True)
    got = {r["id"]: r for r in df.collect()}
    assert got[1]["revenue"] == 2900000000  # wide money kept as long
    assert got[2]["revenue"] is None  # absent key -> null
    assert "unknown" not in df.columns  # extra key ignored
    assert got[1]["extraction_date"] == dt.date(2024, 3, 27)


def test_parquet_sink_fails_if_exists(spark, tmp):
    df = spark.range(3)
    path = os.path.join(tmp, "t")
    write_parquet(df, path)
    with pytest.raises(Exception):
        write_parquet(df, path)
    write_parquet(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("n,sizes", [(205, [69, 68, 68]), (200, [67, 67, 66]), (99, [99]), (100, [50, 50])])
def test_json_balanced_sink(spark, tmp, n, sizes):
    df = spark.range(n).withColumn("title", F.concat(F.lit("Filme ç "), F.col("id").cast("string")))
    out = os.path.join(tmp, f"json{n}")
    parts = write_json_balanced(df, out, ["id"], max_per_file=100)
    assert parts == len(sizes)
    got, ids = [], []
    for name in glob.glob(os.path.join(out, "*.json")):
        with open(name, encoding="utf-8") as fh:
            lines = fh.read().splitlines()
        got.append(len(lines))
        ids += [json.loads(x)["id"] for x in lines]
        assert "ç" in lines[0]  # not escaped
    assert sorted(got, reverse=True) == sizes and sorted(ids) == list(range(n))


def test_json_balanced_sink_over_many_tasks(spark, tmp, monkeypatch):
    from cinelake.sources import sinks

    monkeypatch.setattr(sinks, "FILES_PER_TASK", 2)
    out = os.path.join(tmp, "many")
    assert write_json_balanced(spark.range(1234), out, ["id"], max_per_file=10) == 124
    sizes = sorted(sum(1 for _ in open(f)) for f in glob.glob(os.path.join(out, "*.json")))
    assert len(sizes) == 124 and sum(sizes) == 1234 and sizes[-1] - sizes[0] <= 1


def test_id_list_sink(spark, tmp):
    out = os.path.join(tmp, "errors")
    write_id_list(spark.createDataFrame([("tt1",), ("tt2",)], "id string"), out)
    text = "".join(open(f).read() for f in glob.glob(os.path.join(out, "*.csv")))
    assert sorted(text.split()) == ["tt1", "tt2"]


def test_landing_inventory(spark, tmp):
    write_text(os.path.join(tmp, "Raw", "Local", "CSV", "Movies", "2024", "03", "20"), "Filmes E Series.csv", "a|b\n")
    write_text(tmp, "skip.txt", "x")
    inv = landing_inventory(spark, tmp, "*.csv").collect()
    assert len(inv) == 1
    assert inv[0]["dataset"] == "Filmes e series" and inv[0]["size_bytes"] == 4
    assert inv[0]["landed_on"] == dt.date(2024, 3, 20)


def test_land_once_skips_existing_target(spark, tmp):
    from cinelake.sources import land_once

    target = os.path.join(tmp, "Raw", "Local", "CSV", "Movies", "2024", "03", "20")
    land_once(spark.createDataFrame([("a",)], "x string"), target, "csv")
    land_once(spark.createDataFrame([("b",), ("c",)], "x string"), target, "csv")  # exists: skipped
    assert [r.x for r in spark.read.csv(target, schema="x string").collect()] == ["a"]


def test_land_once_redoes_a_half_written_landing(spark, tmp):
    from cinelake.sources import land_once

    target = os.path.join(tmp, "landing")
    os.makedirs(os.path.join(target, "_temporary", "0"))
    write_text(target, "part-00000-half.csv", "half")
    assert land_once(spark.createDataFrame([("a",)], "x string"), target, "csv")
    assert [r.x for r in spark.read.csv(target, schema="x string").collect()] == ["a"]
    assert not land_once(spark.createDataFrame([("b",)], "x string"), target, "csv")


def test_json_capped_sink(spark, tmp):
    from cinelake.sources import write_json_capped

    out = os.path.join(tmp, "capped")
    write_json_capped(spark.range(250).coalesce(1), out, 100)
    sizes = sorted(sum(1 for _ in open(f)) for f in glob.glob(os.path.join(out, "*.json")))
    assert sizes == [50, 100, 100]


def test_observed_funnel_counts(spark):
    from pyspark.sql import Observation

    from cinelake import operators as op

    obs = Observation("funnel")
    df = spark.createDataFrame([(1, 40), (2, 10), (3, None)], "id int, votes int")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("votes") >= 30).alias("enough_votes"))
    assert out.filter(F.col("votes") >= 30).count() == 1
    assert obs.get == {"rows": 3, "enough_votes": 1}
    funnel = op.Funnel()
    assert funnel("kept", funnel("all", df).filter("votes is not null")).count() == 2
    assert [(r.stage, r.n_rows) for r in funnel.rows(spark).collect()] == [("all", 3), ("kept", 2)]


def test_fact_write_spreads_a_hot_year(spark, tmp):
    from cinelake.sources import write_fact

    fact = spark.range(0, 60000, 1, 12).select(
        F.col("id").alias("id_movie"), F.xxhash64("id").alias("noise"),
        F.when(F.col("id") % 4 < 3, F.lit(2005)).otherwise(F.lit(2010)).alias("release_year"),  # 75% in one year
    )
    out = os.path.join(tmp, "fact")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "64k")
    try:
        write_fact(fact, out)
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    hot = glob.glob(os.path.join(out, "release_year=2005", "*.parquet"))
    assert len(hot) > 2  # the hot year is written by several tasks, as its size asks for
    assert spark.read.parquet(out).count() == 60000

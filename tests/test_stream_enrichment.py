"""Enrichment on arrival equals the batch job after every drain, whichever side comes first."""

import os
import time

import pytest
from pyspark.sql.group import GroupedData

from cinelake.plans import enrich
from cinelake.sources import read_delimited, read_json_lines
from cinelake.streaming import enrichment, enrichment_figures, stream_enrichment
from tests.test_jobs import write

CREDITS, DETAILS = "id string, genero string", "imdb_id string, title string"


def films(tmp, name, *rows):
    write(f"{tmp}/credits/{name}.csv", "id|genero\n" + "".join(f"{i}|{tags}\n" for i, tags in rows))


def details(tmp, name, *ids):
    write(f"{tmp}/details/{name}.json", "".join(f'{{"imdb_id": "{i}", "title": "T"}}\n' for i in ids))


def drain(spark, tmp, **options):
    return stream_enrichment(spark, f"{tmp}/credits", f"{tmp}/details", f"{tmp}/events", f"{tmp}/ckpt", CREDITS, DETAILS, **options)


def batch(spark, tmp):
    asked = read_delimited(spark, f"{tmp}/credits", CREDITS).filter("genero like '%Fantasy%'").select("id").distinct()
    return enrich.mark_found(asked, read_json_lines(spark, f"{tmp}/details", DETAILS), "id", "imdb_id")


def test_every_drain_equals_the_batch_job(spark, tmp):
    films(tmp, "a", ("t1", "Fantasy"), ("t2", "Drama"), ("t3", "Fantasy"), ("t1", "Fantasy"))
    details(tmp, "a", "t1", "t2", "t4")
    got = drain(spark, tmp)
    assert sorted(map(tuple, got.collect())) == [("t1", "found"), ("t3", "pending")]
    figures = enrichment_figures(got).first()
    assert (figures.n_requested, figures.n_found, figures.n_missing) == (2, 1, 1)
    films(tmp, "b", ("t4", "Action,Fantasy"), ("t5", "Fantasy"))  # t4's details came first
    details(tmp, "b", "t3", "t3")  # late
    got = drain(spark, tmp, max_files_per_trigger=1)
    assert sorted(map(tuple, got.collect())) == [("t1", "found"), ("t3", "found"), ("t4", "found"), ("t5", "pending")]
    assert sorted((r.id, r.status == "found") for r in got.collect()) == sorted(map(tuple, batch(spark, tmp).collect()))


def test_ids_that_wait_too_long_are_missing(spark, tmp):
    films(tmp, "a", ("t1", "Fantasy"), ("t2", "Fantasy"))
    details(tmp, "a", "t2")
    drain(spark, tmp, timeout_days=1 / 86_400)
    time.sleep(2)
    films(tmp, "b", ("t3", "Fantasy"))
    got = drain(spark, tmp, timeout_days=1 / 86_400)
    assert {r.id: r.status for r in got.collect()}["t1"] == "missing"
    assert {r.id: r.status for r in got.collect()}["t2"] == "found"
    assert os.path.isdir(f"{tmp}/events")


def test_no_python_runs_for_each_id(spark, tmp, monkeypatch):
    def per_id(*_, **__):
        raise AssertionError("a Python call for each id")

    monkeypatch.setattr(GroupedData, "applyInPandasWithState", per_id)
    films(tmp, "a", *[(f"t{i}", "Fantasy") for i in range(3000)])
    details(tmp, "a", *[f"t{i}" for i in range(0, 6000, 2)])
    figures = enrichment_figures(drain(spark, tmp)).first()
    assert (figures.n_requested, figures.n_found) == (3000, 1500)


def test_a_replayed_batch_adds_nothing(spark, tmp, monkeypatch):
    films(tmp, "a", ("t1", "Fantasy"), ("t2", "Fantasy"))
    details(tmp, "a")
    drain(spark, tmp)
    details(tmp, "b", "t1")
    plain = enrichment.WaitingIds.step

    def broken(self, rows, batch):
        plain(self, rows, batch)
        raise RuntimeError("lost before the batch was committed")

    with monkeypatch.context() as m:
        m.setattr(enrichment.WaitingIds, "step", broken)
        with pytest.raises(Exception, match="lost before"):
            drain(spark, tmp)
    got = drain(spark, tmp)
    assert sorted(map(tuple, got.collect())) == [("t1", "found"), ("t2", "pending")]
    events = spark.read.parquet(f"{tmp}/events").select("id", "status").collect()
    assert sorted(map(tuple, events)) == [("t1", "found"), ("t1", "pending"), ("t2", "pending")]


def test_each_arrival_starts_the_time_anew_and_freed_ids_start_over(spark, tmp, monkeypatch):
    clock = [1_000.0]
    monkeypatch.setattr(enrichment.time, "time", lambda: clock[0])

    def at(day):
        clock[0] = 1_000.0 + 86_400 * day
        return dict(map(tuple, drain(spark, tmp).collect()))

    films(tmp, "a", ("t1", "Fantasy"), ("t2", "Fantasy"))
    details(tmp, "a", "t3")
    assert at(0) == {"t1": "pending", "t2": "pending"}
    films(tmp, "b", ("t1", "Fantasy"))
    assert at(20) == {"t1": "pending", "t2": "pending"}
    films(tmp, "c", ("t4", "Fantasy"))
    assert at(40) == {"t1": "pending", "t2": "missing", "t4": "pending"}  # 30 days; t1 came again on day 20
    details(tmp, "d", "t1", "t2")
    films(tmp, "d", ("t3", "Fantasy"))  # its details were freed
    assert at(45) == {"t1": "found", "t2": "missing", "t3": "pending", "t4": "pending"}


def test_nothing_landed(spark, tmp):
    os.makedirs(f"{tmp}/credits")
    os.makedirs(f"{tmp}/details")
    assert drain(spark, tmp).collect() == []

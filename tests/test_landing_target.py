"""The landing target: same rows after a lost checkpoint, a replayed batch, an attempt without a
commit, another trigger size; and what a batch reads."""

import os

import pytest

from cinelake import jobs
from cinelake.streaming import landing, stream_trusted_details
from tests.test_streaming import land, rec


def rows(df):
    return sorted((r.id, r.revenue, str(r.extraction_date)) for r in df.collect())


@pytest.fixture()
def lake(spark, tmp):
    raw, out = os.path.join(tmp, "Raw"), os.path.join(tmp, "trusted")

    def drain(checkpoint, files=None):
        return rows(stream_trusted_details(spark, raw, out, os.path.join(tmp, checkpoint), max_files_per_trigger=files))

    def batch():
        return rows(jobs.trusted_details_job(spark, raw, os.path.join(tmp, "batch")))

    return raw, out, drain, batch


def test_lost_checkpoint_and_other_trigger_size(lake):
    raw, _, drain, batch = lake
    day = os.path.join(raw, "2024", "03", "27")
    for i in range(3):
        land(day, f"part-{i}.json", [rec(2 * i), rec(2 * i + 1), rec(0)])
    want = batch()
    assert len(want) == 6
    assert drain("one", 1) == drain("two", 1) == drain("three", 2) == drain("four") == want
    land(day, "part-3.json", [rec(1), rec(9)])
    land(os.path.join(raw, "2024", "03", "28"), "part-0.json", [rec(1)])
    land(raw, "undated.json", [rec(1), rec(1)])
    want = batch()
    assert len(want) == 9
    assert drain("four", 1) == drain("five", 3) == want


def test_an_attempt_without_a_commit_is_replaced(lake):
    raw, out, drain, batch = lake
    land(os.path.join(raw, "2024", "03", "27"), "a.json", [rec(1), rec(2)])
    want = drain("one")
    markers = os.path.join(out, "_commits")
    for name in os.listdir(markers):  # written, but never committed
        os.remove(os.path.join(markers, name))
    assert drain("two") == want == batch()
    for name in os.listdir(markers):
        os.remove(os.path.join(markers, name))
    land(os.path.join(raw, "2024", "03", "27"), "b.json", [rec(2), rec(3)])  # the next batch is another one
    assert drain("three") == batch()


def test_a_changed_file_lands_its_new_records(lake):
    raw, _, drain, _ = lake
    day = os.path.join(raw, "2024", "03", "27")
    land(day, "a.json", [rec(1)])
    drain("one")
    land(day, "a.json", [rec(1), rec(2, revenue=5)])
    assert [r[0] for r in drain("two")] == [1, 2]


def test_a_batch_reads_its_own_dates_and_only_on_a_hit(lake, monkeypatch):
    raw, _, drain, _ = lake
    for day in range(10, 20):
        land(os.path.join(raw, "2024", "03", str(day)), "a.json", [rec(day)])
    drain("one")
    read = []
    plain = landing.LandingTarget._read

    def spy(self, part, dates, *rest):
        read.append((part, [str(d) for d in dates]))
        return plain(self, part, dates, *rest)

    monkeypatch.setattr(landing.LandingTarget, "_read", spy)
    land(os.path.join(raw, "2024", "03", "20"), "a.json", [rec(1)])
    land(os.path.join(raw, "2024", "03", "19"), "b.json", [rec(2)])
    drain("one")
    assert {d for _, dates in read for d in dates} == {"2024-03-19", "2024-03-20"}
    assert all(part for part, _ in read)  # no fingerprint was read
    read.clear()
    land(os.path.join(raw, "2024", "03", "19"), "c.json", [rec(2), rec(19)])
    assert len(drain("one")) == 12
    assert ("", ["2024-03-19"]) in read


def test_full_maps_only_cost_a_look(lake, monkeypatch):
    monkeypatch.setattr(landing.LandingTarget.__init__, "__defaults__", (3,))  # every bit is set
    raw, _, drain, batch = lake
    day = os.path.join(raw, "2024", "03", "27")
    for i in range(4):
        land(day, f"part-{i}.json", [rec(i), rec(i + 1)])
    assert drain("one", 1) == batch()

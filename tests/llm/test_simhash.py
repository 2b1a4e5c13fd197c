import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cinelake.llm import simhash
from tests.llm import odd


def fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(prints, radius=2):
    """Smallest member of each component, by all pairs."""
    prints = sorted(set(prints))
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin(a ^ b).count("1") <= radius:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_every_near_pair_shares_a_table():
    rnd = random.Random(1)
    for radius in (1, 2):
        masks = [m & (2**64 - 1) for m in simhash.covering_masks(radius)]
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            a = rnd.getrandbits(64)
            b = a
            for _ in range(radius):
                b ^= 1 << rnd.randrange(64)
            assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize(("radius", "pairwise"), [(2, 8), (2, 1), (1, 8), (1, 1)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, radius, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rnd = random.Random(2)
    prints = set()
    for _ in range(12):
        p = rnd.getrandbits(64)
        for _ in range(15):
            prints.add(p)
            for _ in range(rnd.randint(0, 4)):
                p ^= 1 << rnd.randrange(64)
    signed = [(p - (p >> 63 << 64),) for p in prints]
    df = simhash.links(spark.createDataFrame(signed, "fp long"), radius)
    mask = 2**64 - 1
    edges = [(r[0] & mask, r[1] & mask) for r in df.collect()]
    assert all(0 < bin(a ^ b).count("1") <= 2 for a, b in edges)
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert {p: find(p) for p in prints} == roots(prints, radius)


def test_groups_of_odd_and_near_texts(spark):
    rnd = random.Random(3)
    base = odd.prose(9, 700).split()
    texts = [None, "", " \n", "One", "one two", "A b C"]
    for _ in range(40):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [odd.prose(100 + i, 50) for i in range(20)]
    docs = odd.documents(spark, texts)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    mask = 2**64 - 1
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by_id[i].fp & mask == fingerprint(t) for i, t in enumerate(texts))
    root = roots([r.fp & mask for r in got])
    low = {}
    for r in got:
        if r.doc_id is not None:
            c = root[r.fp & mask]
            low[c] = min(low.get(c, r.doc_id), r.doc_id)
    assert all(r.component_id == low.get(root[r.fp & mask]) for r in got)
    assert len(low) < len(texts) - 5  # some near copies met

    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    named = sorted(r.doc_id for r in kept.filter("doc_id is not null").collect())
    assert named == sorted(low.values())
    assert kept.filter("doc_id is null").count() == 2


def test_empty_table(spark):
    assert simhash.near_duplicates(odd.documents(spark, empty=True)).count() == 0
    assert simhash.keep_one(odd.documents(spark, empty=True)).count() == 0


def test_fingerprint_of_a_very_long_text(spark):
    text = odd.prose(5, 40000)
    got = simhash.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(F.hex("fp")).first()[0]
    assert int(got, 16) == fingerprint(text)


def test_rows_of_one_id_with_different_texts_are_judged_apart(spark):
    a, b, c = (odd.prose(i, 60) for i in (21, 22, 23))
    docs = spark.createDataFrame([(1, a, "u"), (5, a, "u"), (5, b, "u"), (5, b, "u"), (7, c, "u"), (None, a, "u")], "doc_id long, text string, `meta.url` string")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([("1", a), ("5", b), ("7", c), ("None", a)])


def test_text_ids(spark):
    docs = spark.createDataFrame([("x", odd.prose(1, 60)), ("y", odd.prose(1, 60)), ("z", odd.prose(2, 60))], "doc_id string, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == ["x", "z"]

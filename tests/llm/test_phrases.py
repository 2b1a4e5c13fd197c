import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import Broadcast

from cinelake.llm import phrases
from tests.llm import odd

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=3, least=10, cover=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in cand.items():
            around = [b for h, b in cand.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
            if any(100 * b >= cover * a for b in around):
                continue
            score, _, l, r = min((1000000 * a * a // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, g, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, g.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).select(*COLUMNS).collect())


def texts(seed, n):
    rnd = random.Random(seed)
    words = ["new", "york", "City", "of", "the", "état", "日本", "a", "'s", "x\u0000", "rock-n-roll", "w" * 40]
    gaps = [" ", " ", " ", "  ", "\t", " \t ", ", ", ".", "\n", "\r\n", " ; "]
    return [rnd.choice(["", " ", "."]) + "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # several tries, several flushes, hash buckets that collide all the time
        for name, value in (("TRIE", 40_000), ("BUCKETS", 97), ("HELD", 64), ("RUN", 500)):
            monkeypatch.setattr(phrases, name, value)
        monkeypatch.setattr(phrases.frequent, "__defaults__", (3, 10, 97, 40_000, 300_000))
    rows = [(["en", None, "und", "fr\n", ""][i % 5], t) for i, t in enumerate(texts(1, 1200))] + [("en", None), (None, None)]
    rows += [("de", "alles klar alles klar")] * 12
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(3)
    want = brute(rows)
    assert len(want) > 60
    assert found(docs) == want


def test_longer_phrases_and_limits(spark):
    rows = [("en", t) for t in texts(2, 120)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert found(docs, longest=4, least=3, cover=80, top=7) == brute(rows, 4, 3, 80, 7)


def test_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == brute([(r.lang, r.text) for r in docs.collect()])


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**13
    rows = [("en", "a b", 2, big - 1), ("en", "a", 1, big + 7), ("en", "b", 1, big + 9), ("en", "c d", 2, 10), ("en", "c", 1, 10), ("en", "d", 1, big)]
    table = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 5)], "lang string, n long")
    got = {r.phrase: r.score for r in phrases.ranked(table, totals).collect()}
    assert got == {"a b": 1000000 * (big - 1) ** 2 // ((big + 7) * (big + 9)), "c d": 0}


@settings(deadline=None, max_examples=50)
@given(st.sets(st.binary(max_size=6) | st.sampled_from([b"a", b"ab", b"abc", b"abd", bytes(range(30))]), min_size=1, max_size=60))
def test_a_trie_holds_its_keys(keys):
    keys = sorted(keys)
    off = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
    trie = phrases.build(np.frombuffer(b"".join(keys), np.uint8), off)
    prefixes = {k[:i] for k in keys for i in range(len(k) + 1)}
    for p in prefixes:
        state = trie.walk(p)
        assert state >= 0 and trie.accepted(np.array([state])).tolist() == ([keys.index(p)] if p in keys else [])
        for c in range(0, 256, 5):
            assert (trie.walk(p + bytes([c])) >= 0) == (p + bytes([c]) in prefixes)


def test_many_keys_share_one_array():
    rng = np.random.default_rng(1)
    keys = sorted({bytes(rng.integers(97, 123, rng.integers(1, 9)).tolist()) for _ in range(20000)})
    off = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
    trie = phrases.build(np.frombuffer(b"".join(keys), np.uint8), off)
    assert trie.accepted(np.array([trie.walk(k) for k in keys])).tolist() == list(range(len(keys)))
    assert len(trie.base) < 3 * sum(map(len, keys))


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    docs = odd.documents(spark, empty=empty)
    assert found(docs) == brute([(r.lang, r.text) for r in docs.collect()])


def test_the_driver_hands_memory_back_after_each_trie(spark, monkeypatch):
    handed, destroyed = [], []
    plain = phrases.hand_back
    monkeypatch.setattr(phrases, "hand_back", lambda s: (handed.append(len(destroyed)), plain(s)))
    gone = Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda b, blocking=False: (destroyed.append(blocking), gone(b, blocking)))
    docs = spark.createDataFrame([("en", "one two three four") for _ in range(20)], "lang string, text string")
    got = {(r.phrase, r.f) for r in phrases.frequent(docs, trie=40, hold=1)[0].collect()}
    assert ("one two three", 20) in got and len(got) == 9
    tries = len(destroyed)
    assert tries > 1 and all(destroyed) and len(handed) == 2 * tries and handed[-1] == tries


def test_texts_are_read_twice_whatever_the_number_of_tries(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([("en", "one two three four") for _ in range(20)], "lang string, text string")
    docs = docs.mapInArrow(counted, "lang string, text string")
    got = {(r.phrase, r.f) for r in phrases.frequent(docs, trie=40, hold=1)[0].collect()}
    assert ("two three four", 20) in got and len(got) == 9
    assert seen.value == 40


def test_languages_that_differ_by_a_line_feed(spark):
    rows = [("fr", "a b")] * 12 + [("fr\n", "a b a")] * 15
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert found(docs) == brute(rows)


@pytest.mark.parametrize("buckets", [97, 1 << 42])
def test_the_filter_has_all_hot_buckets_and_few_others(buckets):
    rng = np.random.default_rng(3)
    hot = np.unique(rng.integers(0, buckets, 20_000).astype(np.uint64))
    f = phrases.Filter(len(hot), buckets)
    block = hot // np.uint64(1 << 32)
    for b in np.unique(block):
        for at in phrases._spots(hot[block == b] % np.uint64(1 << 32), f.bits, f.width):
            at = at + int(b) * f.bits
            np.bitwise_or.at(f.map, at >> 3, (1 << (at & 7)).astype(np.uint8))
    assert f.has(hot).all()
    if buckets > 97:
        assert f.has(rng.integers(0, buckets, 100_000).astype(np.uint64)).mean() < 0.03


def test_tasks_get_small_batches(spark, monkeypatch):
    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", 50_000
    monkeypatch.setattr(phrases, "BATCH", most)
    rows, large, plain = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), phrases.tidy

    def watched(run):
        def seen(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                large.add(batch.nbytes > most + 40_000)  # a batch ends with the row that passes the limit
                yield batch

        return plain(lambda batches: run(seen(batches)))

    monkeypatch.setattr(phrases, "tidy", watched)
    before = spark.conf.get(name)
    text = "one two three four, " * 1000
    docs = spark.createDataFrame([("en", text + str(i)) for i in range(60)], "lang string, text string").coalesce(1)
    got = {(r.phrase, r.f) for r in phrases.frequent(docs)[0].collect()}
    assert ("one two three", 60_000) in got and len(got) == 9
    assert rows.value > 120 and large.value == 0
    assert spark.conf.get(name) == before


def test_windows_are_written_in_small_row_groups(spark, monkeypatch):
    written, plain = [], phrases.materialize
    monkeypatch.setattr(phrases, "materialize", lambda df, purpose, *options: written.append((purpose, plain(df, purpose, *options))) or written[-1][1])
    monkeypatch.setattr(phrases, "BATCH", 200_000)
    monkeypatch.setattr(phrases, "HELD", 4_000)
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(20_000)]
    docs = spark.createDataFrame([("en", " ".join(rnd.sample(words, 500))) for _ in range(600)], "lang string, text string").coalesce(1)
    got = phrases.frequent(docs, trie=60_000)[0].collect()
    count = Counter(w for r in docs.collect() for w in r.text.split())
    assert {(r.phrase, r.f) for r in got if r.words == 1} == {(w, n) for w, n in count.items() if n >= 10}
    folder = pq.ParquetDataset(dict(written)["phrase-windows"].inputFiles()[0].removeprefix("file://"))
    sizes = [f.row_group(i).total_byte_size for piece in folder.fragments for f in [piece.metadata] for i in range(f.num_row_groups)]
    assert sum(sizes) > 1_000_000 and max(sizes) < 600_000

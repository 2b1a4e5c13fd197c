"""Quality, toxicity and language: held-out accuracy and defined cases."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cinelake.llm import classifier, langid, toxicity
from cinelake.llm.common import text_slices
from cinelake.llm.queries import QUERIES
from tests.llm import odd

SF = "/root/testdata/sf0.1"


def crc(key, m):
    return zlib.crc32(str(key).encode()) % m


@pytest.mark.parametrize(("query", "label", "threshold", "least"), [("op5_quality", "quality", 0.3, 0.95), ("op1_toxicity", "toxic", 0.5, 0.97)])
def test_held_out_accuracy(spark, query, label, threshold, least):
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES[query](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
    held = [(r.score, y[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in y]
    assert np.mean([p == t for _, t, p in held]) >= least
    good, bad = [s for s, t, _ in held if t], [s for s, t, _ in held if not t]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) >= 0.95


def test_language_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op9_language"](spark, SF).collect()
    assert len(rows) == len(lang) and all(r.held_out == (crc(r.doc_id, 4) == 2) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) >= 0.97


def label_rows(n=10):
    return [(i, i % 2, i % 2) for i in range(n)] + [(3, None, None), (None, 1, 1), (4, 1, 1)]


@pytest.mark.parametrize("run", [lambda d, l: classifier.quality(d, l), lambda d, l: toxicity.toxicity(d, l)])
def test_odd_rows_and_missing_labels(spark, run):
    docs = odd.documents(spark)
    for rows in ([], [(i, 1, 1) for i in range(9)], label_rows()):
        got = run(docs, odd.labels(spark, rows)).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        same = [r.score for r in got if r.doc_id in (5, 6)]
        assert len(set(same)) == 1  # repeated rows and equal texts
    assert run(odd.documents(spark, empty=True), odd.labels(spark, label_rows())).count() == 0


def test_quality_gate_keeps_rows_whole(spark):
    docs = odd.documents(spark)
    kept = classifier.keep_good(docs, odd.labels(spark), threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(400):
        t = np.sort(rng.choice(60, rng.integers(0, 8), replace=False))
        w = rng.random(len(t)) + 0.01
        rows.append((t, w / np.linalg.norm(w) if len(t) else w))
    index = toxicity.BlockMaxIndex(rows, 60)
    dense = np.zeros((400, 60))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    for k in (1, 7, 500):
        for t, w in rows[:80]:
            ids, scores = index.nearest(t, w, k)
            q = np.zeros(60)
            q[t] = w
            s = dense @ q
            want = [i for i in np.lexsort((np.arange(400), -s)) if s[i] > 1e-12][:k]
            assert len(ids) == len(want) and np.allclose(np.sort(scores)[::-1], s[want])


def ppm_bits(texts, query):
    """Code length of method C without exclusion, orders 3 to 0, written out plainly."""
    def stream(text):
        s = [b + 1 for b in text.encode().lower()]
        return [(tuple(s[i - k] if i >= k else 0 for k in (3, 2, 1)), c) for i, c in enumerate(s)]

    counts = [defaultdict(Counter) for _ in range(4)]
    for t in texts:
        for ctx, c in stream(t):
            for k in range(4):
                counts[k][ctx[3 - k :]][c] += 1
    bits = 0.0
    for ctx, c in stream(query):
        for k in (3, 2, 1, 0):
            seen = counts[k].get(ctx[3 - k :])
            if seen:
                n, q = sum(seen.values()), len(seen)
                if c in seen:
                    bits += math.log2(n + q) - math.log2(seen[c])
                    break
                bits += math.log2(n + q) - math.log2(q)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    texts = {"a": ["the rain in spain", "the plain", "x"], "b": ["der regen über den wäldern", "ein haus", ""], "c": ["雨が降る", "\x00\x7f"], "d": [""]}
    model = langid.train(texts)
    queries = ["the haus", "Über", "zzz", "", "spain rain", "x", "雨", "\x00", "DER RAIN", "\U0001f600ein"]
    for _, _, data, off in text_slices(pa.array(queries)):
        got = langid.code_lengths(model, data, off)
    for i, q in enumerate(queries):
        for j, l in enumerate(texts):
            assert got[i, j] == pytest.approx(ppm_bits(texts[l], q), abs=1e-3)


def test_every_context_of_the_sample_is_kept():
    rng = np.random.default_rng(3)
    texts = {l: ["".join(map(chr, rng.integers(1, 0x3000, 4000)))] for l in "ab"}  # far more contexts than a dense table would hold
    model = langid.train(texts)
    probe = [texts["a"][0][:300], texts["b"][0][-200:], "".join(map(chr, rng.integers(1, 0x3000, 50)))]
    for _, _, data, off in text_slices(pa.array(probe)):
        got = langid.code_lengths(model, data, off)
    for i, q in enumerate(probe):
        for j, l in enumerate("ab"):
            assert got[i, j] == pytest.approx(ppm_bits(texts[l], q), rel=1e-5)


def test_places_find_every_key_and_no_other():
    rng = np.random.default_rng(5)
    keys = np.unique(np.concatenate([np.arange(300), rng.integers(0, 1 << 36, 5000)]).astype(np.uint64))
    places = langid.Places(keys)
    assert (places.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 36, 5000).astype(np.uint64), keys)
    assert (places.find(others) == -1).all()
    assert (langid.Places(keys[:0]).find(others) == -1).all()


def test_equal_languages_go_to_the_smallest():
    texts = {"b": ["abc abd"], "a": ["abc abd"]}
    model = langid.train(texts)
    for _, _, data, off in text_slices(pa.array(["noise", "abd abc", "", "more noise", "abd abc"])):
        assert (langid.code_lengths(model, data, off).argmin(axis=1) == 0).all()
    assert model.languages[0] == "a"


def test_language_of_odd_rows(spark):
    docs = odd.documents(spark)
    got = langid.identify(docs).collect()
    assert len(got) == docs.count()
    pred = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(pred[i].lang_pred == "und" and pred[i].score == 0 for i in (0, 1, 2, 8))
    assert pred[9].lang_pred == "en" and 0 < pred[9].score <= 1
    nothing = docs.withColumn("lang", docs["lang"].substr(9, 1)).filter("lang is null")
    assert {r.lang_pred for r in langid.identify(nothing).collect()} == {"und"}
    assert langid.identify(odd.documents(spark, empty=True)).count() == 0


def test_equal_ranges_have_equal_sums():
    from cinelake.llm.common import group_sums

    rng = np.random.default_rng(1)
    one = rng.normal(size=(9, 2)) * 1e9
    values = np.concatenate([rng.normal(size=(5, 2)), one, rng.normal(size=(3, 2)), one])
    got = group_sums(values, np.array([0, 0, 5, 14, 14, 17, 26, 26]))
    assert (got[2] == got[5]).all() and not got[[0, 3, 6]].any()
    assert np.allclose(got[1], values[:5].sum(axis=0))


def test_a_repeated_key_cannot_fill_the_sample(spark):
    from cinelake.llm import langid
    from cinelake.llm.common import labelled_sample

    docs = spark.range(3000).selectExpr("7L AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    found, totals = labelled_sample(docs, odd.labels(spark, [(7, 1, 1)]), "quality", 50)
    assert len(found) <= 50 and totals.sum() <= 1
    assert len(langid.fit(docs, langid.Params(per_language=50)).languages) <= 1


def test_a_column_with_a_dot_survives(spark):
    docs = spark.createDataFrame([(i, odd.prose(i, 20), "u") for i in range(6)], "doc_id long, text string, `meta.url` string")
    assert classifier.keep_good(docs, odd.labels(spark)).columns == docs.columns


def test_text_ids_of_examples(spark):
    words = ["vile", "rotten", "filth"]
    rows = [(f"d{i}", odd.prose(i, 30) + (" " + " ".join(words) * 3 if i % 2 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(k, 1, i % 2) for i, (k, _) in enumerate(rows)], "doc_id string, quality int, toxic int")
    got = toxicity.toxicity(docs, labels)
    assert got.schema["doc_id"].dataType.simpleString() == "string" and got.count() == 60

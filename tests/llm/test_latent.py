import random

import numpy as np
import pytest

from cinelake.llm import latent
from cinelake.llm.queries import QUERIES
from tests.llm import odd


def test_common_subsequence_is_longest():
    rnd = random.Random(5)
    for _ in range(300):
        a = np.array([rnd.randrange(6) for _ in range(rnd.randint(0, 12))], np.uint64)
        b = np.array([rnd.randrange(6) for _ in range(rnd.randint(0, 14))], np.uint64)
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        flags = latent.common_subsequence(a, b)
        assert flags.sum() == t[-1, -1]
        rest = iter(b.tolist())  # the flagged words are a subsequence of b
        assert all(any(x == y for y in rest) for x in a[flags].tolist())


def corpus():
    rnd = random.Random(8)

    def word():
        return "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8)))

    common = ["the", "of", "and", "to", "in"]
    items = [(i, " ".join(rnd.choice(common) if rnd.random() < 0.3 else word() for _ in range(rnd.randint(20, 60)))) for i in range(30)]

    def filler(n):
        return " ".join(rnd.choice(common) if rnd.random() < 0.4 else word() for _ in range(n))

    docs, planted = [], set()
    for i in range(200):
        parts = [filler(rnd.randint(0, 200))]
        if i % 4 == 0:
            k = rnd.randrange(30)
            text = items[k][1]
            if i % 8 == 0:  # a paraphrase: some words changed, case and punctuation too
                w = text.split()
                for _ in range(len(w) // 8):
                    w[rnd.randrange(len(w) - 6)] = word()
                text = ", ".join(w).upper()
            parts += [text, filler(rnd.randint(0, 200))]
            planted.add((i, k))
        docs.append((i, " ".join(parts)))
    return docs, items, planted


def test_copies_and_paraphrases_are_found(spark):
    docs, items, planted = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([*items, (90, None), (91, "too short"), (92, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in latent.leaks(d, b).collect()}
    assert got == planted
    blocks = {(r.doc_id, r.item_id) for r in latent.leaks(d, b, latent.Params(block=7)).collect()}
    assert len(blocks & planted) >= 0.9 * len(planted) and blocks <= planted
    clean = latent.decontaminate(d, b)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in planted}


@pytest.mark.parametrize("items", [[], [(1, None)], [(None, odd.prose(1, 80)), (3, odd.prose(1, 80))]])
def test_odd_rows(spark, items):
    docs = odd.documents(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = latent.leaks(docs, bench).collect()
    clean = latent.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    hit = {r.doc_id for r in got}
    assert clean.count() == docs.count() - sum(r.doc_id in hit for r in docs.collect())
    assert latent.leaks(odd.documents(spark, empty=True), bench).count() == 0
    assert latent.decontaminate(odd.documents(spark, empty=True), bench).count() == 0


def test_every_verbatim_passage_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    true = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_latent"](spark, sf).collect()}
    assert true <= got and len(got - true) <= 2


def word_list(rnd, n):
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(4, 8))) for _ in range(n)]


def test_paraphrases_with_words_outside_the_benchmark_and_short_items_whatever_the_block(spark):
    rnd = random.Random(31)
    common = word_list(rnd, 40)  # of the documents only: frequent, and in no item
    items = [(i, " ".join(word_list(rnd, n))) for i, n in enumerate([12, 20, 30, 40, 60, 90, 150, 400] * 3)]
    items += [(100, "quay xylem"), (101, "vex"), (102, "quay of xylem")]
    docs, planted = [], set()
    for i in range(24):
        w = items[i][1].split()
        for k in rnd.sample(range(len(w) - 6), int(0.35 * len(w))):
            w[k] = rnd.choice(common)
        docs.append((i, " ".join([*rnd.choices(common, k=300), *w, *rnd.choices(common, k=300)])))
        planted.add((i, i))
    docs += [(50 + i, " ".join(rnd.choices(common, k=200))) for i in range(40)]
    docs += [(200, "a Quay, xylem and"), (201, "quay xylems"), (202, "xylem quay"), (203, "VEX"), (204, "quay"), (205, "xylem")]
    planted |= {(200, 100), (203, 101)}
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = {block: sorted(tuple(r) for r in latent.leaks(d, b, latent.Params(block=block)).collect()) for block in (2000, 5)}
    assert {r[:2] for r in rows[2000]} == planted
    assert [r[:2] for r in rows[5]] == [r[:2] for r in rows[2000]]
    assert np.allclose([r[2:] for r in rows[5]], [r[2:] for r in rows[2000]], atol=1e-4)
    assert latent.decontaminate(d, b, latent.Params(block=5)).count() == len(docs) - len(planted)


def test_a_scrambled_passage_does_not_hide_the_copy(spark):
    rnd = random.Random(12)
    items = [(i, " ".join(word_list(rnd, 40))) for i in range(12)]
    docs = []
    for i, text in items:
        w = text.split()
        scrambled = w[::-1]  # the same words: the highest cosine there is
        copied = list(w)
        for k in rnd.sample(range(34), 8):
            copied[k] = rnd.choice(items[(i + 1) % 12][1].split())
        docs.append((i, " ".join([*scrambled, *word_list(rnd, 400), *copied, *word_list(rnd, 50), *scrambled])))
        docs.append((100 + i, " ".join([*scrambled, *word_list(rnd, 400), *scrambled])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in latent.leaks(d, b).collect()) == [(i, i) for i in range(12)]


def test_text_ids_and_odd_names(spark):
    from cinelake.llm import latent
    from tests.llm import odd

    item = odd.prose(31, 60)
    docs = spark.createDataFrame([("a", odd.prose(2, 40) + " " + item, "u"), ("b", odd.prose(3, 80), "u")], "doc_id string, text string, `meta.url` string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.doc_id for r in latent.leaks(docs, benchmark).collect()} == {"a"}
    clean = latent.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and [r.doc_id for r in clean.collect()] == ["b"]

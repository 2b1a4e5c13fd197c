import hashlib
import random
from collections import Counter

import pytest

from cinelake.llm import suffixes
from tests.llm import odd


def brute(docs, match):
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(r[i : i + match] for r in raw for i in range(len(r) - match + 1))
    out = []
    for (key, _), r in zip(docs, raw):
        gone = bytearray(len(r))
        for i in range(len(r) - match + 1):
            if seen[r[i : i + match]] > 1:
                gone[i : i + match] = b"\1" * match
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((key, len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=3, n=90):
    rnd = random.Random(seed)

    def para(k):
        return " ".join("".join(rnd.choice("abcdeéß ") for _ in range(rnd.randint(2, 8))) for _ in range(k))

    shared = [para(rnd.randint(30, 90)) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = [para(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            parts += [s[rnd.randint(0, 40) : len(s) - rnd.randint(0, 40)], para(rnd.randint(0, 40))]
        docs.append((i, "".join(parts)))
    docs += [(200, docs[5][1]), (201, docs[6][1] + "x"), (202, None), (203, ""), (204, "a" * 1000), (205, "b" * 199)]
    docs += [(206, "ab" * 300), (None, docs[7][1]), (207, para(9000)), (5, docs[5][1]), (5, docs[9][1])]
    return docs


@pytest.mark.parametrize(("match", "hot", "batches"), [(200, 4096, 4), (50, 3, 3)])
def test_removes_what_brute_force_removes(spark, monkeypatch, match, hot, batches):
    monkeypatch.setattr(suffixes, "HOT", hot)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = suffixes.remove_repeats(df, match, max(10, match // 5), batches).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, match)


def test_levels_merge_geometrically_and_scan_finds_shared_keys(spark):
    docs = spark.createDataFrame(corpus(7, 60), "doc_id long, text string")
    family = suffixes.IndexFamily(spark, 200, 40)
    sizes, shared = [], 0
    for b in range(5):
        shared += family.insert(docs.filter(f"coalesce(doc_id, 0) % 5 = {b}")).count()
        sizes.append(sorted(rank for rank, _ in family.levels))
    assert sizes == [[0], [0, 0], [0, 1], [0, 0, 1], [0, 2]]
    alone = suffixes.IndexFamily(spark, 200, 40)
    alone.insert(docs)
    assert sorted(map(tuple, family.repeated().collect())) == sorted(map(tuple, alone.repeated().collect()))
    assert shared > 0
    # the scans alone give what one merge of all levels gives
    (_, table), = alone.levels
    merged = spark.table(table).filter("n > 1").selectExpr("key", "low = high")
    assert sorted(map(tuple, family.repeated().collect())) == sorted(map(tuple, merged.collect()))
    held = {t.name for t in spark.catalog.listTables()}
    assert {t for _, t in family.levels} <= held
    family.close()
    alone.close()


def test_nothing_but_the_marked_texts_stays(spark):
    before = {t.name for t in spark.catalog.listTables()}
    suffixes.remove_repeats(spark.createDataFrame(corpus(7, 30), "doc_id long, text string")).collect()
    left = {t.name.rsplit("_", 1)[0] for t in spark.catalog.listTables() if t.name not in before}
    assert left == {"suffix_documents"}


def test_text_ids_and_odd_names(spark):
    docs = spark.createDataFrame(corpus(7, 30), "doc_id long, text string")
    named = docs.selectExpr("concat('d', doc_id) AS doc_id", "text", "'u' AS `meta.url`")
    got = suffixes.without_repeats(named)
    assert got.columns == named.columns
    plain = {f"d{r.doc_id}" if r.doc_id is not None else None: r.text for r in suffixes.without_repeats(docs).collect()}
    assert {r.doc_id: r.text for r in got.collect()} == plain


def test_a_merge_of_levels_needs_no_shuffle(spark):
    docs = spark.createDataFrame(corpus(7, 30), "doc_id long, text string")
    family = suffixes.IndexFamily(spark)
    a, b = (spark.table(suffixes._bucketed(family.suffix_array(docs), ["key"], "suffix-array")) for _ in range(2))
    assert "Exchange" not in family.merge(a, b)._jdf.queryExecution().executedPlan().toString()


def test_texts_stay_whole_rows(spark):
    docs = odd.documents(spark)
    got = suffixes.without_repeats(docs)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert got.count() == docs.count()
    texts = {r.doc_id: r for r in got.collect()}
    assert texts[5].text == "" and texts[5].n_chars == 0  # an exact copy is there
    assert texts[0].text is None and texts[1].text == ""
    assert texts[9].text == odd.prose(3, 60) and texts[9].key == "clash"
    assert suffixes.without_repeats(odd.documents(spark, empty=True)).count() == 0


def test_ranges_are_told_apart_by_whole_fingerprints(spark):
    docs = spark.createDataFrame(corpus(11, 40), "doc_id long, text string")
    ends = suffixes.IndexFamily(spark, 200, 40).suffix_array(docs).select("low", "high")
    assert {t for _, t in ends.dtypes} == {"bigint"}
    values = {abs(v) for r in ends.collect() for v in r}
    assert sum(v >> 32 > 0 for v in values) > 0.9 * len(values) and len({v & 0xFFFFFFFF for v in values}) > 0.9 * len(values)

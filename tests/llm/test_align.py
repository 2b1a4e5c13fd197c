import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cinelake.llm import align, bytebpe
from cinelake.llm.common import text_slices
from tests.llm import odd

PAIR = align.load()
A = Tokenizer.from_file(align.BYTES_FILE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=align.PIECES_FILE)
SHOWN = {i: bytebpe.decode(PAIR.a, [i]) for i in range(len(PAIR.a.place) - 1)}


def piece_bytes(i):
    return bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()


def groups_of(text):
    """Groups ([A ids], [B ids]) of a text by the two libraries and sets of ends."""
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    raw_a, raw_b = [SHOWN[i] for i in a], [piece_bytes(i) for i in b]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return []
    ends = [np.cumsum([len(r) for r in raw]).tolist() for raw in (raw_a, raw_b)]
    out, i, j = [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(e) + 1, ends[1].index(e) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def expected(texts):
    every = [groups_of(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in every]
    count = Counter(p for link in links for p in link)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for g, link in zip(every, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append(
            (
                sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(link.values()),
                sum(w for p, w in link.items() if count[p] == best[p[0]]), sum(w * count[p] for p, w in link.items()),
                hashlib.sha256(text.encode()).hexdigest() if g else "",
            )
        )
    return rows


ODD = ["▁ literal", "日本語 text 😀", " ", "  two", "trailing  ", "\n\t", "a" * 700, "<s> </s> <|endoftext|>", "ﬁ ½ é", "don't we'll", "x\u0000y", "…" * 50]


@given(st.lists(st.integers(1, 60), min_size=1, max_size=300, unique=True), st.lists(st.integers(1, 300), max_size=300), st.integers(1, 9))
def test_groups_are_the_common_ends(x, y, size):
    last = max(*x, *y, 61) + 1 if y else max(*x, 61) + 1
    ea, eb = np.array(sorted({*x, last})), np.array(sorted({*y, last}))
    ga, gb = align.align(ea, eb, size)
    assert ea[ga - 1].tolist() == eb[gb - 1].tolist() == sorted(set(ea.tolist()) & set(eb.tolist()))


def test_the_tokenizers_are_the_libraries(spark):
    import pyarrow as pa

    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ODD + [odd.prose(9, 3000)]
    for i, j, data, off in text_slices(pa.array([" " + t if t else "" for t in texts]), align.SLAB):
        (a, at, _), (b, bt, _) = PAIR.encode(data, off)
        for k, t in enumerate(texts[i:j]):
            if "▁" not in t:
                assert a[at[k] : at[k + 1]].tolist() == (A.encode(" " + t, add_special_tokens=False).ids if t else [])
                assert b[bt[k] : bt[k + 1]].tolist() == B.encode(t)
            else:
                assert at[k] == at[k + 1] and bt[k] == bt[k + 1]


@pytest.mark.parametrize("slab", [200, align.SLAB])
def test_whole_query(spark, monkeypatch, slab):
    monkeypatch.setattr(align, "SLAB", slab)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()] + ODD + ["the the the"] * 3
    docs = odd.documents(spark, texts).repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted((str(i), *r) for (i, _), r in zip(rows, expected([t for _, t in rows])))
    got = align.digests(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_large_groups_pair_their_distinct_ids(monkeypatch):
    a, b = np.array([1, 2, 1, 5]), np.array([7, 7, 8])
    ends = np.array([3, 4]), np.array([2, 3]), np.array([0, 0])

    def found():
        out = Counter()
        for d, key, w in zip(*align.linked(a, b, *ends)):
            out[d, key >> 32, key & 0xFFFFFFFF] += w
        return out

    want = found()
    assert want[0, 1, 7] == 4 and want[0, 2, 7] == 2 and want[0, 5, 8] == 1 and sum(want.values()) == 7
    monkeypatch.setattr(align, "LARGE", 1)
    assert found() == want


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    docs = odd.documents(spark, empty=empty)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted((str(i), *r) for (i, _), r in zip(rows, expected([t for _, t in rows])))
    got = align.digests(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    whole = align.aligned(docs.withColumnRenamed("source", "meta.url"))
    assert "meta.url" in whole.columns
    for r in whole.collect():
        assert len(r.ends_a) == len(r.ends_b) and (not r.a or (r.ends_a[-1], r.ends_b[-1]) == (len(r.a), len(r.b)))


def test_text_ids(spark):
    docs = spark.createDataFrame([("a", "x y"), (None, None)], "doc_id string, text string")
    assert {r.doc_id: r.n_a for r in align.digests(docs).collect()} == {"a": 2, None: 0}


def test_a_slab_in_parts_over_batches_is_the_slab():
    import pyarrow as pa

    texts = [f" {odd.prose(k, 40)}" for k in range(30)] + ["", " ▁ literal", " " + "…" * 90] + [f" {odd.prose(2, 60)}"] * 3
    ids = pa.array(range(len(texts)))

    def found(step, *sizes):
        batches = (pa.RecordBatch.from_arrays([ids[k : k + step], pa.array(texts[k : k + step])], ["i", "t"]) for k in range(0, len(texts), step))
        return [(pa.concat_arrays(i).to_pylist(), len(p), align.slab_rows(p)) for i, p in align._slab_parts(PAIR, batches, *sizes)]

    ((whole, parts, want),) = found(len(texts), 1 << 20, 1 << 20, 100)
    assert parts == 1 and whole == ids.to_pylist()
    ((same, parts, got),) = found(7, 1 << 20, 500, 100)
    assert parts > 15 and same == whole
    for k in want:
        assert np.array_equal(got[k], want[k]), k
    # an entry is a place in the pairs and a weight, each as wide as it has to be
    assert len(got["pairs"]) < 256 and got["entry"].itemsize == got["weight"].itemsize == 1
    for sizes, most in (((1500, 500, 100), 100), ((1 << 20, 1 << 20, 5), 7)):
        cut = found(7, *sizes)
        assert [i for s, _, _ in cut for i in s] == whole and max(len(s) for s, _, _ in cut) <= most
        assert [x for _, _, g in cut for x in g["groups_sha256"]] == want["groups_sha256"]
        assert sum(len(g["entry"]) for _, _, g in cut) == len(want["entry"])


def test_wide_weights_and_places_stay_whole():
    for x in ([], [0, 255], [256], [1 << 16], [1 << 32, 3]):
        got = align._narrow(np.array(x, np.int64))
        assert got.tolist() == x and got.itemsize == np.min_scalar_type(max(x, default=0)).itemsize


def test_slab_tasks_get_small_batches_and_write_small_row_groups(spark, monkeypatch):
    import pyarrow.parquet as pq

    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", 50_000
    monkeypatch.setattr(align, "BATCH", most)
    monkeypatch.setattr(align, "SLAB", 30_000)
    rows, large, plain = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), align.tidy

    def watched(run):
        def seen(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                large.add(batch.nbytes > most + 10_000)  # a batch ends with the row that passes the limit
                yield batch

        return plain(lambda batches: run(seen(batches)))

    monkeypatch.setattr(align, "tidy", watched)
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(k, odd.prose(k, 600)) for k in range(300)], "doc_id long, text string").coalesce(1)
    table = align.slabs(docs)
    assert rows.value == 300 and large.value == 0
    assert spark.conf.get(name) == before
    groups = [m.row_group(g) for m in (pq.ParquetFile(f.removeprefix("file:")).metadata for f in table.inputFiles()) for g in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) > 30 and len(groups) > 3 and max(g.num_rows for g in groups) < 16

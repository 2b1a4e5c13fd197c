import numpy as np

from cinelake.llm import graphann
from cinelake.llm.queries import QUERIES

SMALL = graphann.Params(shard=300, block=40)


def brute(vectors, ids, query, k):
    own = ids == query
    s = vectors @ vectors[np.flatnonzero(own)[0]]
    s[own] = -np.inf
    best = np.lexsort((ids, -s))[: min(k, (~own).sum())]
    return list(zip(ids[best].tolist(), s[best].tolist()))


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], "vec_id long, embedding array<float>, cid string, shard string")


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    x *= rng.random((1500, 1)).astype(np.float32) + 0.5  # inner product, not cosine
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = graphann.nearest(table(spark, rows), p=SMALL).collect()
    ids, x = np.arange(1500), x.astype(float)
    hits = total = 0
    for q in range(0, 1500, 20):
        mine = sorted(((r.rank, r.vec_id, r.score) for r in got if r.query_id == q))
        want = brute(x, ids, q, 20)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(abs(s - x[v] @ x[q]) < 1e-9 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        hits += len({v for v, _ in want} & {m[1] for m in mine})
        total += 20
    assert hits / total >= 0.9


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rows = [(i, [1.0, 0.0]) for i in range(100)] + [(100 + i, [0.5, float(i)]) for i in range(1, 8)]
    bad = [(200, None), (220, []), (240, [0.0, 0.0]), (260, [None, 1.0]), (280, [float("nan"), 1.0]), (300, [float("inf"), 0.0]), (320, [1.0, 2.0, 3.0]), (None, [9.0, 9.0])]
    got = graphann.nearest(table(spark, rows + bad), p=SMALL).collect()
    assert {r.query_id for r in got} == {0, 20, 40, 60, 80}
    for q in (0, 20, 40):
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        assert mine == [i for i in range(22) if i != q][:20]


def test_few_and_no_rows(spark):
    got = graphann.nearest(table(spark, [(0, [1.0]), (1, [2.0]), (2, [3.0])]), p=SMALL).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 2), (2, 1)]
    assert graphann.nearest(table(spark, []), p=SMALL).count() == 0
    assert graphann.nearest(table(spark, [(20, [1.0])]), p=SMALL).count() == 0


def test_recall_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = QUERIES["op7_neighbours"](spark, sf).collect()
    queries = sorted({r.query_id for r in got})
    assert queries == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = sum(len({v for v, _ in brute(x, ids, q, 20)} & {r.vec_id for r in got if r.query_id == q}) for q in queries)
    assert hits >= 0.9 * 20 * len(queries)

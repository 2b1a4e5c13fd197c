import hashlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cinelake.llm import bytebpe
from cinelake.llm.common import text_slices
from tests.llm import odd

import public_tokenizers  # isort: skip

V = bytebpe.load()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=V.whole, special_tokens={})
SIGNS = "abstmdrevl'' ''  \n\t\r12é日.,!  ́😀_\u0000"


def encode(texts):
    out = []
    for _, _, data, off in text_slices(pa.array(texts, pa.string()), bytebpe.RUN):
        ids, bounds = bytebpe.encode_run(V, data, off)
        out += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    return out


@settings(max_examples=300)
@given(st.lists(st.text(alphabet=st.sampled_from(list(SIGNS)), max_size=30) | st.text(max_size=20), max_size=8))
def test_it_is_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = encode(texts)
    assert got == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [bytebpe.decode(V, g).decode() for g in got] == texts


def test_whole_texts_of_the_table(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["a" * 5000, " " * 3000 + "x", "'" * 99, "日本語" * 400, "don't we'll they've I'm he'd 're 'rex !'s", "<|endoftext|>"]
    assert encode(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_every_codepoint_has_the_library_s_class():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}1{c}\n" for c in every[::37])
    assert encode([text]) == [LIBRARY.encode_ordinary(text)]


def test_the_scan_composes_like_one_step_after_the_other():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 256, 70_001):
        symbols = rng.integers(0, len(bytebpe.SYMBOL), n)
        state, want = 0, []
        for x in symbols:
            state = int(bytebpe.APPLY[bytebpe.SYMBOL[x], state])
            want.append(state)
        assert bytebpe.APPLY[bytebpe.scan(bytebpe.SYMBOL[symbols]), 0].tolist() == want


def test_long_slices_merge_as_short_ones(monkeypatch):
    slices = [w.encode() for w in odd.prose(5, 400).split()] + [b"underneath" * 4, bytes(range(256)), b"aaaaaaaaa"]
    want = [g.tolist() for g in bytebpe.merge_many(V, slices)]
    assert [bytebpe.merge_one(V, s) for s in slices] == want
    monkeypatch.setattr(bytebpe, "WIDE", 3)
    assert [g.tolist() for g in bytebpe.merge_many(V, slices)] == want


def test_a_hash_collision_is_noticed(monkeypatch):
    class Weak(bytebpe.RollingHash):
        def of(self, start, end):
            return super().of(start, end) % np.uint64(7)

    monkeypatch.setattr(bytebpe, "RollingHash", Weak)
    monkeypatch.setattr(V, "memo", None)
    texts = [odd.prose(i, 40) for i in range(4)]
    assert encode(texts) == [LIBRARY.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(V, "memo", None)


def test_a_full_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(V, "memo", bytebpe.Memo(lambda s: bytebpe.merge_many(V, s), limit=20))
    texts = [odd.prose(i, 60) for i in range(6)]
    for t in texts:
        assert encode([t]) == [LIBRARY.encode_ordinary(t)]
    monkeypatch.setattr(V, "memo", None)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    docs = odd.documents(spark, empty=empty)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = sorted(
        (str(i), len(ids := LIBRARY.encode_ordinary(t)), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for i, t in rows
    )
    assert sorted((str(r.doc_id), *r[1:]) for r in bytebpe.digests(docs).collect()) == want
    tokens = bytebpe.encode(docs.withColumnRenamed("source", "meta.url"))
    back = bytebpe.decoded(tokens).collect()
    assert sorted((str(r.doc_id), bytes(r.bytes).decode()) for r in back) == sorted((str(i), t) for i, t in rows)
    assert "meta.url" in tokens.columns and tokens.schema["doc_id"] == docs.schema["doc_id"]
    for r in tokens.collect():
        assert len(r.ends) == len(r.ids) and (not r.ids or r.ends[-1] == len(bytebpe.decode(V, r.ids)))


def test_text_ids(spark):
    docs = spark.createDataFrame([("a", "x y"), (None, None)], "doc_id string, text string")
    assert {r.doc_id: r.n_tokens for r in bytebpe.digests(docs).collect()} == {"a": 2, None: 0}

import numpy as np
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st

from cinelake.llm import pieces
from tests.llm import odd

VOCABULARY = pieces.load()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
PLAIN = pieces.Encoder(VOCABULARY, pieces.Params(dropout=0.0))
DROPPED = pieces.Encoder(VOCABULARY, pieces.Params(dropout=0.3))
ODD = ["", " ", "  a  b", "a ", "\n x\t y", "日本語 text 😀", "<s> </s> <0x0A> <unk>", "a\u0000b", "    four", "don't (x) a.b !! %%% ---"]


def test_without_dropout_it_is_the_library(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    for t in [*texts, *ODD, odd.prose(3, 300)]:
        assert PLAIN.encode(t).tolist() == LIBRARY.encode(t)


@given(st.text(alphabet=st.sampled_from(list("ab é▁ \n.,'日😀́\u0000")), max_size=40) | st.text(max_size=40), st.integers(0, 2**62))
def test_round_trip(text, key):
    text = text.encode("utf-8", "ignore").decode()
    for e in (PLAIN, DROPPED):
        assert pieces.decode(VOCABULARY, e.encode(text, key)) == text


def agenda(chunk, key, limit):
    """Merge-dropout of one chunk, plainly: look at all neighbours for the best candidate not yet skipped."""
    sym = [(VOCABULARY.ids.get(c), i, c) for i, c in enumerate(chunk)]
    skipped = set()
    while True:
        found = []
        for n in range(len(sym) - 1):
            (a, i, _), (b, _, _) = sym[n], sym[n + 1]
            at = None if a is None or b is None else VOCABULARY.pairs.get(a << 32 | b)
            if at is not None and (at, i) not in skipped:
                found.append((at, i, n))
        if not found:
            return [x for s, _, c in sym for x in ([s] if s is not None else [VOCABULARY.byte[y] for y in c.encode()])]
        at, i, n = min(found)
        h = ((key ^ (at << 32 | i)) * 0xBF58476D1CE4E5B9) % 2**64
        if ((h ^ h >> 29) * 0x94D049BB133111EB) % 2**64 >> 32 < limit:
            skipped.add((at, i))
        else:
            sym[n : n + 2] = [(VOCABULARY.merged[at], i, "")]


def test_dropout_is_the_agenda_one_by_one(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect() if r.text]
    texts = [t[:4000] for t in texts] + [t for t in ODD if t and pieces.SPACE not in t] + ["underneath " * 60, "x" * 90, "日本語 " * 5]
    chunks = sorted({c for t in texts for c in (pieces.SPACE + t.replace(" ", pieces.SPACE)).split(" ")})
    chunks = [w for c in chunks for w in ["\u2581" + x for x in c.split("\u2581")]][:3000]
    keys = np.random.default_rng(4).integers(0, 1 << 63, len(chunks)).astype(np.uint64)
    for e in (PLAIN, DROPPED):
        code = [[VOCABULARY.ids.get(x, pieces.STRANGE + ord(x)) for x in c] for c in chunks]
        size = np.array([len(c) for c in code])
        got, n, _, _ = e.merge_many(np.array([x for c in code for x in c]), np.cumsum(size) - size, size, keys)
        cut = np.split(got, np.cumsum(n)[:-1])
        for c, plain, k, g in zip(chunks, code, keys.tolist(), cut):
            ids = [x for s in g.tolist() for x in ([s] if s < pieces.STRANGE else [VOCABULARY.byte[b] for b in chr(s - pieces.STRANGE).encode()])]
            assert ids == agenda(c, k, e.limit)
            one, _ = e.merge(plain, k)
            assert one == g.tolist()


def test_every_occurrence_draws_anew():
    text = " ".join(["underneath"] * 10_000)
    got = DROPPED.encode(text, 1)
    # pieces that begin with a space begin a word
    heads = np.array([VOCABULARY.surface[VOCABULARY.place[i] : VOCABULARY.place[i] + 1] == b" " for i in got])
    cuts = {tuple(c.tolist()) for c in np.split(got, np.flatnonzero(heads)[1:])}
    assert len(cuts) > 4 and len(got) > len(PLAIN.encode(text))
    other = pieces.Encoder(VOCABULARY, pieces.Params(dropout=0.3))
    assert np.array_equal(other.encode(text, 1), got) and not np.array_equal(other.encode(text, 2), got)
    assert pieces.Encoder(VOCABULARY, pieces.Params(dropout=0.3, seed=5)).encode(text, 1).tolist() != got.tolist()


def test_the_memo_does_not_change_what_is_drawn(monkeypatch):
    texts = [odd.prose(i, 200) for i in range(30)]
    want = [DROPPED.encode(t, i).tolist() for i, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "MEMO", 10)
    small = pieces.Encoder(VOCABULARY, pieces.Params(dropout=0.3))
    assert [small.encode(t, i).tolist() for i, t in enumerate(texts)] == want


def test_chunks_of_one_hash_are_noticed(spark, monkeypatch):
    class Weak(pieces.RollingHash):
        def of(self, start, end):
            return super().of(start, end) % np.uint64(5)

    texts = [odd.prose(i, 5) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    data = docs.selectExpr("doc_id", "doc_id AS key", "concat(' ', text) AS text").toArrow().to_batches()
    monkeypatch.setattr(pieces, "RollingHash", Weak)

    class Shared:
        value = VOCABULARY

    # a document alone may still hold two chunks of one hash: then it says that it is not lossless
    for batch in pieces._encode_arrow(Shared, pieces.Params(), True)(data):
        for i, same, ids in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
            assert same == (pieces.decode(VOCABULARY, ids) == texts[i])


def test_text_ids(spark):
    docs = spark.createDataFrame([("a", "x y"), (None, None), ("b", "x y")], "doc_id string, text string")
    assert {r.doc_id: r.lossless for r in pieces.tokenize(docs).collect()} == {"a": True, "b": True, None: True}


def test_everything_dropped_leaves_characters():
    assert len(pieces.Encoder(VOCABULARY, pieces.Params(dropout=1.0)).encode("abc def")) == len("▁abc▁def")


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    docs = odd.documents(spark, empty=empty)
    got = pieces.tokenize(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in got:
        assert r.lossless and r.n_tokens == len(r.ids)
        if r.doc_id is not None:
            assert pieces.decode(VOCABULARY, r.ids) == (texts[r.doc_id] or "")


@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_a_round_looks_pairs_up_once(monkeypatch, dropout):
    e = pieces.Encoder(VOCABULARY, pieces.Params(dropout=dropout))
    calls = []
    plain = e._pair
    monkeypatch.setattr(e, "_pair", lambda left, right: (calls.append(1), plain(left, right))[1])
    chunks = [" internationalisation", " a", "日本語", " übergangsweise", " the", " 😀x"]
    syms = [e.symbols(np.frombuffer(c.encode(), np.uint8))[0] for c in chunks]
    size = np.array([len(s) for s in syms])
    keys = np.arange(len(syms), dtype=np.uint64) if dropout else None
    got, n, took, m = e.merge_many(np.concatenate(syms), np.cumsum(size) - size, size, keys)
    want = [e.merge(s.tolist(), None if keys is None else i) for i, s in enumerate(syms)]
    assert got.tolist() == [x for ids, _ in want for x in ids] and n.tolist() == [len(ids) for ids, _ in want]
    merges = max(len(entries) for _, entries in want)
    if not dropout:
        assert took.tolist() == [x for _, entries in want for x in entries] and len(calls) <= 1 + merges

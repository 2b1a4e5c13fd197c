"""Toxicity by nearest labelled examples.

Terms are lower-cased words and the first ``PREFIX`` bytes of longer words.  The vocabulary
holds the terms that separate the classes of a bounded labelled sample (chi-square of at
least ``chi2``); document frequencies, hence the idf, are counted over all documents.  Every
document's TF-IDF vector is compared with the examples by exact cosine through a block-max
inverted index: postings lie in blocks of ``BLOCK`` examples with the largest weight of each
term in each block, blocks are visited by falling upper bound, and the visit ends when no
bound beats the k-th best score.  The k nearest vote by 1 / (distance + SOFT), weighted
back to the classes' shares among all labels; a logistic fit on the examples' leave-one-out
votes calibrates the result.  The nearest examples and the heaviest terms are the evidence.

Defined cases: null, empty and term-free texts have an empty vector: they score the
labelled share of toxic among the examples without terms, calibrated alike.  Equal cosines go
to the smaller example number (examples are in a fixed order).  Null labels are not learned
from; without labels of both classes every score is the smoothed class share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import RollingHash, crc_mod, labelled_sample, lower_ascii, text_slices

BLOCK = 64
PREFIX = 5
SOFT = 0.1
_LETTER = np.zeros(256, bool)
_LETTER[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True


@dataclass(frozen=True)
class Params:
    per_class: int = 1500  # bound of the labelled sample, examples of each class
    vocabulary: int = 2048
    chi2: float = 25.0
    k: int = 15


def _terms(data: np.ndarray, off: np.ndarray):
    """Hashes of the words and word prefixes of a run of documents, with the document of
    each and its byte range."""
    low = lower_ascii(data)
    ink = _LETTER[low]
    edge = np.diff(np.concatenate([[0], ink.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cross = np.searchsorted(off, start, side="right") != np.searchsorted(off, end - 1, side="right")
    if cross.any():  # a word that touches the next document's first word is cut there
        cuts = np.setdiff1d(off[1:-1], start)
        cuts = cuts[ink[np.minimum(cuts, len(ink) - 1)] & (cuts < len(ink))]
        start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
    roll = RollingHash(low)
    long = end - start > PREFIX
    h = np.concatenate([roll.of(start, end), roll.of(start[long], start[long] + PREFIX) ^ np.uint64(1)])
    s, e = np.concatenate([start, start[long]]), np.concatenate([end, start[long] + PREFIX])
    return h, np.searchsorted(off, s, side="right") - 1, s, e


class Vocabulary:
    def __init__(self, hashes: np.ndarray, names: list[str]):
        self.hashes, self.names = hashes, names
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def counts(self, data, off):
        """(document, term, count) of the terms found, in that order."""
        h, doc, _, _ = _terms(data, off)
        hit = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.hashes, h[hit])
        ok = at < len(self.hashes)
        ok[ok] = self.hashes[at[ok]] == h[hit][ok]
        key, n = np.unique(doc[hit][ok] * (len(self.hashes) + 1) + at[ok], return_counts=True)
        return key // (len(self.hashes) + 1), key % (len(self.hashes) + 1), n


def select_terms(texts: list[str], y: np.ndarray, p: Params) -> Vocabulary:
    """The terms of the sample that separate its classes."""
    hs, ys, names = [], [], {}
    row = 0
    spans = []
    for _, j, data, off in text_slices(pa.array(texts, pa.large_string())):
        h, doc, s, e = _terms(data, off)
        pair = np.unique(np.stack([h, doc.astype(np.uint64)]), axis=1)
        hs.append(pair[0])
        ys.append(y[row + pair[1].astype(np.int64)])
        spans.append((h, s, e, data))
        row = j
    h, yy = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (hs, ys))
    u, inv = np.unique(h, return_inverse=True)
    a, b = np.bincount(inv, yy == 1, len(u)), np.bincount(inv, yy == 0, len(u))
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    n = n1 + n0
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = n * (a * (n0 - b) - b * (n1 - a)) ** 2.0 / (n1 * n0 * (a + b) * (n - a - b))
    chi[~np.isfinite(chi)] = 0
    pick = np.flatnonzero((chi >= p.chi2) & (a + b >= 5))
    kept = np.sort(u[pick[np.argsort(-chi[pick], kind="stable")[: p.vocabulary]]])
    for h, s, e, data in spans:
        for i in np.flatnonzero(np.isin(h, kept)):
            if int(h[i]) not in names:
                names[int(h[i])] = data[s[i] : e[i]].tobytes().decode("utf-8", "replace").lower()
    return Vocabulary(kept, [names[int(x)] for x in kept])


class BlockMaxIndex:
    """Inverted index of unit vectors: for each term and block of examples a row of dense
    postings (where the term occurs there at all) and its largest weight."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        n = len(rows)
        self.n, self.blocks = n, -(-n // BLOCK)
        self.at = np.zeros((n_terms, max(1, self.blocks)), np.int32)
        postings = [np.zeros(BLOCK)]
        for i, (terms, weights) in enumerate(rows):
            for t, w in zip(terms, weights):
                if not self.at[t, i // BLOCK]:
                    self.at[t, i // BLOCK] = len(postings)
                    postings.append(np.zeros(BLOCK))
                postings[self.at[t, i // BLOCK]][i % BLOCK] = w
        self.postings = np.array(postings)
        self.top = self.postings.max(axis=1)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest inner product: (numbers, scores), best first."""
        rows = self.at[terms]
        bound = weights @ self.top[rows]
        ids, scores, kth = np.zeros(0, np.int64), np.zeros(0), -1.0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(ids) >= k and bound[b] < kth):
                break
            s = weights @ self.postings[rows[:, b]]
            live = np.flatnonzero(s > 0) if len(ids) < k else np.flatnonzero((s > 0) & (s >= kth))
            if len(live):
                ids, scores = np.concatenate([ids, live + b * BLOCK]), np.concatenate([scores, s[live]])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                kth = scores[-1]
        return ids, scores


@dataclass
class Model:
    vocabulary: Vocabulary
    idf: np.ndarray
    index: BlockMaxIndex
    labels: np.ndarray
    ids: list  # keys of the examples
    weight: np.ndarray  # of a vote, by label
    empty: float  # vote of a document without terms
    k: int
    slope: float = 1.0
    shift: float = 0.0

    def vector(self, terms, counts):
        w = (1 + np.log(counts)) * self.idf[terms]
        norm = np.sqrt((w * w).sum())
        return w / norm if norm else w

    def vote(self, ids, scores) -> float:
        if not len(ids):
            return self.empty
        y = self.labels[ids]
        w = self.weight[y] / (1 - np.minimum(scores, 1) + SOFT)
        return float((w * y).sum() / w.sum())

    def calibrated(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * _logit(vote) + self.shift))))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _platt(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of y on x by bounded Newton steps.  Targets are smoothed by one
    example a class, so that separable votes have a finite fit."""
    n = np.bincount(y, w, 2)
    target = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    beta = np.array([1.0, 0.0])
    feats = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(feats @ beta, -30, 30)))
        g = feats.T @ (w * (p - target)) + 0.1 * (beta - [1, 0])
        h = (feats * (w * p * (1 - p))[:, None]).T @ feats + 0.1 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta = beta - step / max(1.0, np.abs(step).max())
    return float(beta[0]), float(beta[1])


def build(vocabulary: Vocabulary, idf: np.ndarray, texts: list[str], y: np.ndarray, ids: list, totals: np.ndarray, p: Params) -> Model:
    """Index the examples (grouped by label and heaviest term, so that blocks are alike)
    and calibrate on their leave-one-out votes."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j, data, off in text_slices(pa.array(texts, pa.large_string())):
        doc, term, n = vocabulary.counts(data, off)
        cut = np.searchsorted(doc, np.arange(j - i + 1))
        found += [(term[a:b], n[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    share = totals / np.maximum(1, np.bincount(y, minlength=2))
    blank = np.array([not len(t) for t, _ in found])
    empty = float(((y[blank] == 1) * share[1]).sum() + 1) / float(share[y[blank]].sum() + 2)
    model = Model(vocabulary, idf, BlockMaxIndex([], len(idf)), y, ids, share, empty, p.k)
    rows = [(t, model.vector(t, n)) for t, n in found]
    order = sorted(range(len(rows)), key=lambda i: (blank[i], y[i], rows[i][0][rows[i][1].argmax()] if len(rows[i][0]) else -1, i))
    model.index = BlockMaxIndex([rows[i] for i in order], len(idf))
    model.labels, model.ids = y[order], [ids[i] for i in order]
    votes = []
    for place, i in enumerate(order):
        near, s = model.index.nearest(*rows[i], p.k + 1)
        other = near != place
        votes.append(model.vote(near[other][: p.k], s[other][: p.k]))
    model.slope, model.shift = _platt(_logit(np.array(votes)), model.labels, share[model.labels])
    return model


def document_frequencies(docs: DataFrame, shared) -> DataFrame:
    """(term, df) over all rows, with term -1 for the number of rows."""

    def run(batches):
        vocabulary = shared.value
        total, rows = np.zeros(len(vocabulary.hashes), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, off in text_slices(batch.column(0)):
                total += np.bincount(vocabulary.counts(data, off)[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["term", "df"])

    return docs.select("text").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def fit(docs: DataFrame, labels: DataFrame, label: str, p: Params = Params()) -> Model | float:
    """The model, or the smoothed class share where one class has no labels."""
    got, totals = labelled_sample(docs, labels, label, p.per_class)
    y = np.array([r["y"] for r in got], np.int64)
    if len(set(y.tolist())) < 2:
        return float((totals[1] + 1) / (totals.sum() + 2))
    texts = [r["t"] for r in got]
    vocabulary = select_terms(texts, y, p)
    df = {r[0]: r[1] for r in document_frequencies(docs, docs.sparkSession.sparkContext.broadcast(vocabulary)).collect()}
    n = df.get(-1, 0)
    idf = np.array([np.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in range(len(vocabulary.hashes))])
    return build(vocabulary, idf, texts, y, [r["k"] for r in got], totals, p)


def score_arrow(shared):
    def run(batches):
        model: Model = shared.value
        seen: dict[bytes, tuple] = {}
        blank = (model.calibrated(model.empty), [], [])
        for batch in batches:
            out: list[tuple] = []
            for i, j, data, off in text_slices(batch.column(1)):
                doc, term, n = model.vocabulary.counts(data, off)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    if a == b:
                        out.append(blank)
                        continue
                    key = term[a:b].tobytes() + n[a:b].tobytes()
                    got = seen.get(key)
                    if got is None:
                        w = model.vector(term[a:b], n[a:b])
                        ids, s = model.index.nearest(term[a:b], w, model.k)
                        heavy = [model.vocabulary.names[t] for t in term[a:b][np.argsort(-w, kind="stable")[:3]]]
                        got = (model.calibrated(model.vote(ids, s)), [model.ids[x] for x in ids[:3]], heavy)
                        if len(seen) < 20_000:
                            seen[key] = got
                    out.append(got)
            score, near, terms = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array(near, pa.list_(batch.column(0).type)), pa.array(terms, pa.list_(pa.string()))],
                ["doc_id", "score", "neighbours", "terms"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted and the evidence (``neighbours``, ``terms``) for
    every row of ``docs``; see the contract of op1."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    model = fit(docs, labels, "toxic", p)
    if isinstance(model, float):
        scored = docs.select("doc_id", F.lit(model).alias("score"), F.array().cast(f"array<{kind}>").alias("neighbours"), F.array().cast("array<string>").alias("terms"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        scored = docs.mapInArrow(score_arrow(shared), f"doc_id {kind}, score double, neighbours array<{kind}>, terms array<string>")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", predicted, "neighbours", "terms")

"""Quality classifier: supervised subword embeddings.

Learned vectors of hashed words, word pairs and byte n-grams are averaged per document and go through
a softmax; all weights are trained by stochastic gradient descent in numpy on a bounded,
keyed sample of labelled rows.  Scoring folds the embedding and the output layer into one
number per bucket, so a document costs one table look-up per feature and no Python loop.

Defined cases: a null or empty text has no features and gets the bias score; a null label
is never learned from; with no labelled rows, or one class only, all scores are the smoothed
class share (0.5 without labels).  Repeated rows are scored one by one and come out alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.common import crc_mod, group_sums, labelled_sample, mix64, RollingHash, text_slices, tidy, unpacked, whole_rows, word_spans

BUCKETS = 1 << 16
NGRAMS = (3, 4)
SIZE = BUCKETS * (2 + len(NGRAMS))


@dataclass(frozen=True)
class Params:
    per_class: int = 1000  # bound of the training sample, labelled rows of each class
    dim: int = 8
    epochs: int = 8
    rate: float = 4.0
    batch: int = 16
    seed: int = 5


def features(data: np.ndarray, off: np.ndarray):
    """Feature ids of each document: yields (ids, bounds) for words, word pairs and each
    order of n-grams; ids[bounds[i]:bounds[i+1]] belong to document i."""
    roll = RollingHash(data)
    start, end = word_spans(data, off)
    word = roll.of(start, end)
    first = np.searchsorted(start, off)
    yield (word >> np.uint64(48)).astype(np.int64), first
    # word pairs by the XOR of their hashes: all repetitions of a word share one bucket
    pair = (mix64(word[1:] ^ word[:-1]) >> np.uint64(48)).astype(np.int64) + BUCKETS
    keep = np.ones(len(pair), bool)
    cross = first[1:-1] - 1
    keep[cross[(cross >= 0) & (cross < len(pair))]] = False
    yield pair[keep], np.concatenate([[0], np.cumsum(keep)])[np.minimum(first, len(pair))]
    for k, n in enumerate(NGRAMS, 2):
        h = roll.windows(n)
        ids = (h >> np.uint64(48)).astype(np.int64) + k * BUCKETS
        keep = np.ones(len(ids), bool)
        for back in range(1, n):  # n-grams do not cross a document end
            p = off[1:-1] - back
            keep[p[(p >= 0) & (p < len(ids))]] = False
        yield ids[keep], np.concatenate([[0], np.cumsum(keep)])[np.minimum(off, len(ids))]


def _train(texts: list[str], labels: np.ndarray, p: Params) -> tuple[np.ndarray, float]:
    """Folded weight of each bucket, and the bias, for the log odds of label 1."""
    ids, vals, ptr = [], [], [0]
    for _, _, data, off in text_slices(pa.array(texts, pa.large_string()), 1 << 18):
        parts = list(features(data, off))
        for i in range(len(off) - 1):
            f = np.concatenate([x[b[i] : b[i + 1]] for x, b in parts])
            u, c = np.unique(f, return_counts=True)
            ids.append(u)
            vals.append(c / max(1, len(f)))
            ptr.append(ptr[-1] + len(u))
    size = SIZE
    rng = np.random.default_rng(p.seed)
    emb = ((rng.random((size, p.dim)) - 0.5) / p.dim).astype(np.float32)
    out = np.zeros((p.dim, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps = max(1, p.epochs * -(-len(labels) // p.batch))
    done = 0
    for _ in range(p.epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), p.batch):
            pick = order[at : at + p.batch]
            rate = p.rate * (1 - done / steps)
            done += 1
            f = np.concatenate([ids[i] for i in pick])
            v = np.concatenate([vals[i] for i in pick]).astype(np.float32)
            n = np.array([len(ids[i]) for i in pick])
            ends = np.concatenate([[0], np.cumsum(n)])
            hid = group_sums(emb[f] * v[:, None], ends).astype(np.float32)
            z = hid @ out + bias
            z -= z.max(axis=1, keepdims=True)
            prob = np.exp(z)
            prob /= prob.sum(axis=1, keepdims=True)
            err = prob
            err[np.arange(len(pick)), labels[pick]] -= 1
            d_hid = err @ out.T
            out -= rate * (hid.T @ err) / len(pick)
            bias -= 0.1 * rate * err.mean(axis=0)
            g = d_hid[np.repeat(np.arange(len(pick)), n)] * v[:, None]
            u, inv = np.unique(f, return_inverse=True)
            step = np.stack([np.bincount(inv, g[:, k], len(u)) for k in range(p.dim)], axis=1)
            emb[u] -= (rate * step).astype(np.float32)
    fold = emb @ (out[:, 1] - out[:, 0])
    return fold.astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str, params: Params = Params()):
    """(weights, bias) from labelled rows; see Params.per_class for the sample's bound."""
    got, totals = labelled_sample(docs, labels, label, params.per_class)
    prior = float(np.log((totals[1] + 1) / (totals[0] + 1)))
    y = np.array([r["y"] for r in got])
    if len(set(y.tolist())) < 2:
        return np.zeros(SIZE, np.float32), prior
    w, b = _train([r["t"] for r in got], y, params)
    # the sample is balanced; the bias goes back to the classes' shares among all labels
    return w, b + prior - float(np.log(y.mean() / (1 - y.mean())))


def score_arrow(weights: np.ndarray, bias: float, keep: list[str], text: str):
    """mapInArrow function: the ``keep`` columns and the score of ``text``."""

    def run(batches):
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, j, data, off in text_slices(batch.column(batch.schema.get_field_index(text))):
                total = np.zeros(j - i)
                count = np.zeros(j - i)
                for ids, bounds in features(data, off):
                    total += group_sums(weights[ids], bounds)
                    count += np.diff(bounds)
                scores[i:j] = 1 / (1 + np.exp(-(total / np.maximum(1, count) + bias)))
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(scores)], [*keep, "score"])

    return run


def score(rows: DataFrame, text: str, model, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row with ``score`` (0 to 1), from whole texts."""
    weights, bias = model
    src = rows.select(*dict.fromkeys([*keep, text]))
    schema = T.StructType([*(src.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    return src.mapInArrow(tidy(score_arrow(weights, bias, keep, text)), schema)


def quality(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; see the contract of op5."""
    model = fit(docs, labels, "quality", params)
    scored = score(docs.select("doc_id", "text"), "text", model, ["doc_id"])
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, params: Params = Params()) -> DataFrame:
    """The rows of ``docs``, whole, whose quality score is at least ``threshold``."""
    model = fit(docs, labels, "quality", params)
    row = docs.select(whole_rows(docs), F.col("text"))
    return unpacked(score(row, "text", model, ["row"]).filter(F.col("score") >= threshold), docs.columns)

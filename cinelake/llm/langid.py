"""Language identification by prediction by partial matching.

One variable-order byte context tree (orders 3 to 0) per language, with escape
probabilities of method C, is counted once over a bounded, keyed sample of labelled texts
and then frozen.  A document's exact code length under every language follows from the
frozen counts alone: a byte seen in the longest known context costs its share there, any
other costs the escape plus its code in the next shorter context, down to a uniform order
over 256 bytes.  A-Z are folded to a-z.

Every context and every byte value of the sample is kept, whatever its frequency.  The tree
is stored by order: the byte strings of length k + 1 that occur in any language, with their
code under each, and the contexts of length k, with their escape cost under each.  Both are
looked up for a whole run of text at a time in hash tables, so the model grows with the
sample's distinct strings of four bytes and not with a power of the alphabet.

Defined cases: null text, empty text and text without a letter get ``und`` and score 0; a
null lang is never learned from; ties go to the smallest language; without any labelled
text every document is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import bounded_sample, crc_mod, group_sums, lower_ascii, text_slices

UNKNOWN = "und"
ORDER = 3
_BITS = 9  # of a symbol: 0 stands before a text's start, byte b is b + 1
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    per_language: int = 400  # bound of the training sample, documents of each language


class Places:
    """Where each of a sorted set of keys stands, by open addressing over whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.zeros(1 << bits, np.uint64)
        self.place = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.place[slot] < 0
            first = np.unique(slot[free], return_index=True)[1]
            won = np.flatnonzero(free)[first]
            self.key[slot[won]], self.place[slot[won]] = keys[left[won]], left[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is none of the set."""
        slot = self._slot(keys)
        out = self.place[slot]
        open_ = np.flatnonzero((self.key[slot] != keys) & (out >= 0))
        while len(open_):
            slot_ = (slot[open_] + 1) & self.mask
            slot[open_], out[open_] = slot_, self.place[slot_]
            open_ = open_[(self.key[slot_] != keys[open_]) & (self.place[slot_] >= 0)]
        return out


@dataclass
class Order:
    grams: Places  # a context and the byte after it
    code: np.ndarray  # (grams, languages): bits
    contexts: Places
    escape: np.ndarray  # (contexts, languages): bits, 0 where a language lacks the context


@dataclass
class Model:
    languages: list[str]
    orders: list[Order]  # by length of context


def _grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER symbols before it in its document, the oldest on top."""
    s = lower_ascii(data).astype(np.uint64) + np.uint64(1)
    out = s.copy()
    for k in range(1, ORDER + 1):
        b = np.zeros_like(s)
        b[k:] = s[:-k]
        for j in range(k):
            p = off[:-1] + j
            b[p[p < off[1:]]] = 0
        out |= b << np.uint64(_BITS * k)
    return out


def _lower(grams: np.ndarray, k: int) -> np.ndarray:
    """The grams cut to a context of k symbols."""
    return grams & np.uint64((1 << (_BITS * (k + 1))) - 1)


def train(texts: dict[str, list[str]], p: Params = Params()) -> Model:
    langs = sorted(texts)
    counted = []
    for l in langs:
        parts = [np.unique(_grams(data, off), return_counts=True) for _, _, data, off in text_slices(pa.array(texts[l], pa.large_string()))]
        u, inv = np.unique(np.concatenate([np.zeros(0, np.uint64), *[u for u, _ in parts]]), return_inverse=True)
        counted.append((u, np.bincount(inv, np.concatenate([np.zeros(0), *[n for _, n in parts]]), len(u))))
    orders: list[Order] = []
    for k in range(ORDER + 1):
        grams = np.unique(np.concatenate([_lower(u, k) for u, _ in counted]))
        contexts, above = np.unique(grams >> np.uint64(_BITS), return_inverse=True)
        # the shorter code of every gram, in all languages
        if k:
            shorter = orders[-1].code[orders[-1].grams.find(_lower(grams, k - 1))].astype(np.float64)
        else:
            shorter = np.full((len(grams), len(langs)), 8.0)
        code, escape = np.empty(shorter.shape, np.float32), np.zeros((len(contexts), len(langs)), np.float32)
        for j, (u, c) in enumerate(counted):
            n = np.bincount(np.searchsorted(grams, _lower(u, k)), c, len(grams))
            total = np.bincount(above, n, len(contexts))
            kinds = np.bincount(above, n > 0, len(contexts))
            known = total > 0
            cost = np.zeros(len(contexts))
            cost[known] = np.log2((total + kinds)[known]) - np.log2(kinds[known])
            escape[:, j] = cost
            code[:, j] = cost[above] + shorter[:, j]
            seen = n > 0
            code[seen, j] = np.log2((total + kinds)[above[seen]]) - np.log2(n[seen])
        orders.append(Order(Places(grams), code, Places(contexts), escape))
    return Model(langs, orders)


def code_lengths(model: Model, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, languages): exact bits of each document under each language."""
    grams = _grams(data, off)
    at = model.orders[ORDER].grams.find(grams)
    bits = model.orders[ORDER].code[at]  # the misses are overwritten below
    left = np.flatnonzero(at < 0)
    bits[left] = 0
    for k in range(ORDER, -1, -1):
        if not len(left):
            break
        order, g = model.orders[k], _lower(grams[left], k)
        at = order.grams.find(g)
        hit = at >= 0
        bits[left[hit]] += order.code[at[hit]]
        left, g = left[~hit], g[~hit]
        above = order.contexts.find(g >> np.uint64(_BITS))
        known = above >= 0
        bits[left[known]] += order.escape[above[known]]
    bits[left] += 8
    return group_sums(bits, off)


def predict_arrow(shared):
    def run(batches):
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            ids, text, letter = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text", "letter"))
            n = batch.num_rows
            best, score = np.full(n, len(model.languages)), np.zeros(n)
            if model.languages:
                for i, j, data, off in text_slices(text, 1 << 18):
                    bits = code_lengths(model, data, off)
                    best[i:j] = bits.argmin(axis=1)
                    score[i:j] = 1 / np.exp2(np.maximum(-1000, bits.min(axis=1, keepdims=True) - bits)).sum(axis=1)
                mute = ~letter.to_numpy(zero_copy_only=False).astype(bool)
                best[mute], score[mute] = len(model.languages), 0.0
            yield pa.RecordBatch.from_arrays([ids, pa.array(names[best], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return run


def fit(docs: DataFrame, params: Params = Params()) -> Model:
    """Train on the rows of ``docs`` (doc_id, text, lang) with text and lang."""
    rows = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    texts: dict[str, list[str]] = {}
    # a key may stand on any number of rows: one text of each
    sample = bounded_sample(rows, "lang", "doc_id", params.per_language).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    return train(texts, params) if texts else Model([], [])


def identify(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``; see the contract of op9."""
    model = fit(docs.filter(crc_mod("doc_id", 4) != 2), params)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    out = src.mapInArrow(predict_arrow(shared), f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")

"""Benchmark decontamination by latent semantic retrieval.

1. Terms are the benchmark's words without the stop words (words of many items).  One pass
   over all documents counts each term's documents and, over all their passages (runs of
   ``PASSAGE`` words), the product T'(T W) of the passage-term counts T with a random W: the
   range finder of a randomised SVD, added up per term by a distributed sum.
2. Scaled by the idf and joined with the benchmark's own passages, an orthonormal basis of
   its range is the latent space; every term gets a vector there.
3. A second pass slides windows of the items' lengths (a geometric grid) over every whole
   document and folds them into the latent space; items of its length within the cosine bound
   are candidates.  Windows are left out only where the words around hold fewer of the
   item's terms than the test of step 4 asks for.
4. Every candidate window is checked, those of higher cosine first, until one passes: it is
   a leak if the longest common subsequence with the words around covers the item nearly (a
   verbatim copy), or mostly and the answer, the item's last words, as well (a paraphrase).

Terms, idf and latent space are the whole benchmark's; only the items are searched in blocks of
``block``, so that results don't depend on it.  Defined cases: null and empty documents and
items match nothing; an item of fewer than ``least`` words, or of stop words only, is matched
exactly, word by word; repeated items and documents give a row each; with no document the idf
is flat.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import lower_ascii, mix64, text_slices, tidy, unpacked, whole_rows

PASSAGE = 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_LETTER = np.zeros(256, bool)
_LETTER[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True


@dataclass(frozen=True)
class Params:
    rank: int = 64
    block: int = 2000  # items searched at once
    least: int = 8  # words of an item that is searched in the latent space
    cosine: float = 0.6
    copied: float = 0.9  # common subsequence of a verbatim copy, share of the item
    alike: float = 0.6  # of a paraphrase
    answer_words: int = 6
    answer: float = 0.5  # share of the answer found in a paraphrase
    seed: int = 23


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a run of documents (from their length and first,
    middle and last eight bytes), and each document's first word."""
    low = lower_ascii(data)
    ink = np.zeros(len(low) + 2, np.int8)
    ink[1:-1] = _LETTER[low]
    edge = np.diff(ink)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(low))]
    cuts = np.unique(cuts[(ink[cuts] > 0) & (ink[cuts + 1] > 0)])  # words that touch across documents
    if len(cuts):
        start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
    n = end - start
    pad = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.arange(8)
    lead = pad[start[:, None] + eight].view("<u8")[:, 0] & _KEEP[np.minimum(8, n)]
    h = lead * _ODD[0] ^ n.astype(np.uint64) * _ODD[1]
    long = np.flatnonzero(n > 8)  # the other bytes: the last eight, and eight in the middle
    s, e = start[long], end[long]
    for k, at in ((2, e - 8), (3, s + (e - s) // 2 - 4)):
        h[long] ^= mix64(pad[at[:, None] + eight].view("<u8")[:, 0] * _ODD[k])
    return mix64(h), np.searchsorted(start, off)


@dataclass
class Terms:
    terms: np.ndarray  # sorted hashes
    stop: np.ndarray  # sorted hashes of the stop words
    maybe: np.ndarray = field(init=False)
    table: np.ndarray = field(init=False)
    code: np.ndarray = field(init=False)

    def __post_init__(self):
        every = np.concatenate([self.terms, self.stop])
        self.code = np.argsort(every)
        self.table = every[self.code]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(every >> np.uint64(42)).astype(np.int64)] = True

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Each word's term number, stop words after the terms; -1 for other words."""
        out = np.full(len(h), -1)
        some = np.flatnonzero(self.maybe[(h >> np.uint64(42)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.table, h[some]), len(self.table) - 1)
            out[some] = np.where(self.table[at] == h[some], self.code[at], -1)
        return out


def _tokens(text: str | None) -> np.ndarray:
    found = [words(data, off)[0] for _, _, data, off in text_slices(pa.array([text or ""], pa.large_string()))]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _items(benchmark: DataFrame):
    """(id, words) of the benchmark's items that have words, in a fixed order."""
    for r in benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator():
        tokens = _tokens(r[1])
        if len(tokens):
            yield r[0], tokens


def read_terms(benchmark: DataFrame, p: Params) -> Terms:
    """Terms and stop words of the whole benchmark."""
    u, n, items = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def add(held):
        every = np.concatenate([u, *held])
        new, inv = np.unique(every, return_inverse=True)
        return new, np.bincount(inv, np.append(n, np.ones(len(every) - len(u))), len(new)).astype(np.int64)

    held: list[np.ndarray] = []
    for _, tokens in _items(benchmark):
        items += 1
        held.append(np.unique(tokens))
        if len(held) == p.block:
            (u, n), held = add(held), []
    u, n = add(held)
    often = n > max(3, 0.2 * items)
    return Terms(u[~often], u[often])


def _range_arrow(shared, p: Params):
    """Partial document frequencies and T'(T W) of a partition, a row per term."""

    def run(batches):
        terms: Terms = shared.value
        n = len(terms.terms)
        w = np.random.default_rng(p.seed).standard_normal((n, p.rank)).astype(np.float32)
        df, z, rows = np.zeros(n, np.int64), np.zeros((n, p.rank)), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, off in text_slices(batch.column(0)):
                h, first = words(data, off)
                term = terms.lookup(h)
                at = np.flatnonzero((term >= 0) & (term < n))
                if not len(at):
                    continue
                t = term[at]
                doc = np.searchsorted(first, at, side="right") - 1
                df += np.bincount(np.unique(doc * n + t) % n, minlength=n)
                passage = doc * (1 << 24) + (at - first[doc]) // PASSAGE
                cut = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
                y = np.add.reduceat(w[t], cut)
                owner = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(t))))
                by = np.argsort(t, kind="stable")
                heads = np.flatnonzero(np.append(True, t[by][1:] != t[by][:-1]))
                z[t[by][heads]] += np.add.reduceat(y[owner[by]], heads)
        hit = np.flatnonzero(df)
        cols = [pa.array(np.append(hit, -1)), pa.array(np.append(df[hit], rows))]
        flat = np.concatenate([z[hit], np.zeros((1, p.rank))]).astype(np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * p.rank), pa.array(flat.reshape(-1)))
        yield pa.RecordBatch.from_arrays([*cols, lists], ["term", "df", "z"])

    return run


@dataclass
class Space:
    terms: Terms
    idf: np.ndarray
    vectors: np.ndarray  # term vectors: idf times the basis


def fit(docs: DataFrame, benchmark: DataFrame, p: Params) -> Space:
    """The latent space of the documents' and the whole benchmark's passages."""
    terms = read_terms(benchmark, p)
    n = len(terms.terms)
    df, z, total = np.zeros(n), np.zeros((n, p.rank)), 0
    if n:
        shared = docs.sparkSession.sparkContext.broadcast(terms)
        parts = docs.select("text").mapInArrow(tidy(_range_arrow(shared, p)), "term long, df long, z array<float>")
        # a row per benchmark term, whatever the number of documents
        sums = parts.groupBy("term").agg(F.sum("df").alias("df"), F.array(*[F.sum(F.col("z")[i].cast("double")) for i in range(p.rank)]).alias("z")).collect()
        for r in sums:
            if r["term"] < 0:
                total = r["df"]
            else:
                df[r["term"]], z[r["term"]] = r["df"], r["z"]
    idf = np.log((1 + total) / (1 + df)) + 1
    z *= idf[:, None]
    own, energy, rng = np.zeros((n, p.rank)), 0.0, np.random.default_rng(p.seed + 1)
    for _, tokens in _items(benchmark):
        t, weight = _weighted(terms, idf, tokens)
        own[t] += weight[:, None] * rng.standard_normal(p.rank)
        energy += float(weight @ weight)
    if energy:
        scale = np.linalg.norm(z) / np.sqrt(energy)
        left, size, _ = np.linalg.svd(np.concatenate([z, (scale or 1.0) * own], axis=1), full_matrices=False)
        basis = left[:, size > 1e-9 * max(size.max(initial=0), 1e-30)]
    else:
        basis = np.zeros((n, 1))
    return Space(terms, idf, (idf[:, None] * basis).astype(np.float32))


def _weighted(terms: Terms, idf: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = terms.lookup(tokens)
    t, count = np.unique(code[code < len(idf)], return_counts=True)
    return t, count * idf[t]


def _window(length: int) -> tuple[int, int]:
    """Step and number of steps of the windows for items of ``length`` words: the nearest of
    a geometric grid, so that every length is within a quarter of its windows' size."""
    size = 8 * 1.5 ** max(0, round(np.log(length / 8) / np.log(1.5)))
    step = max(2, round(size / 8))
    return step, round(size / step)


@dataclass
class Items:
    """A block of the benchmark."""

    ids: list
    tokens: list[np.ndarray]
    codes: list[np.ndarray]  # term numbers of the words
    latent: np.ndarray  # unit item vectors
    groups: dict  # of items that are searched in the latent space, by their windows
    exact: dict  # of the others, by their number of words


def place_items(block: list[tuple], space: Space, p: Params) -> Items:
    ids, tokens = [k for k, _ in block], [t for _, t in block]
    codes = [space.terms.lookup(t) for t in tokens]
    latent = np.zeros((len(ids), space.vectors.shape[1]), np.float32)
    groups: dict = {}
    exact: dict = {}
    for i, code in enumerate(codes):
        t, count = np.unique(code[code < len(space.idf)], return_counts=True)
        latent[i] = count @ space.vectors[t]
        size = np.linalg.norm(latent[i])
        if len(code) < p.least or size < 1e-12:
            exact.setdefault(len(code), []).append(i)
        else:
            latent[i] /= size
            groups.setdefault(_window(len(code)), []).append(i)
    return Items(ids, tokens, codes, latent, groups, exact)


def common_subsequence(item: np.ndarray, text: np.ndarray, least: float = 0.0) -> np.ndarray:
    """Flags of the item's words in one longest common subsequence with the text, by bit
    vectors: a row of the table is one integer.  No flags if it holds less than the share
    ``least`` of the item."""
    places: dict[int, int] = {}
    for i, t in enumerate(item.tolist()):
        places[t] = places.get(t, 0) | (1 << i)
    full = (1 << len(item)) - 1
    rows, v = [full], full
    for t in text.tolist():
        m = places.get(t, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
        rows.append(v)
    found = np.zeros(len(item), bool)
    i, j = len(item), len(text)
    size = lambda row, k: k - (rows[row] & ((1 << k) - 1)).bit_count()  # noqa: E731  words of the first k in common
    if size(j, i) < least * i - 1e-9:
        return found
    while i and j:
        if item[i - 1] == text[j - 1] and size(j, i) == size(j - 1, i - 1) + 1:
            found[i - 1] = True
            i, j = i - 1, j - 1
        elif size(j - 1, i) == size(j, i):
            j -= 1
        else:
            i -= 1
    return found


def _sequence(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    out = np.zeros(max(0, len(tokens) - n + 1), np.uint64)
    for k in range(n):
        out = mix64(out * _ODD[0] ^ tokens[k : len(tokens) - n + 1 + k])
    return out


class Group:
    """Items that are searched by the same windows, with an inverted index of their terms."""

    CELLS = 8

    def __init__(self, items: np.ndarray, step: int, steps: int, block: Items, n: int, least: float):
        self.items, self.step, self.steps, self.n = items, step, steps, n
        codes = [block.codes[i] for i in items]
        self.longest = max(len(c) for c in codes)
        # words around a window, at most, in cells
        self.width = -(-(3 * max(self.longest, step * steps) - step * steps + step) // self.CELLS)
        # terms that a common subsequence of the share ``least`` holds, at least
        self.need = np.array([max(1, int(np.ceil(least * len(c) - 1e-9)) - int((c >= n).sum())) for c in codes])
        found = [np.unique(c[c < n], return_counts=True) for c in codes]
        term, item = np.concatenate([t for t, _ in found]), np.repeat(np.arange(len(codes)), [len(t) for t, _ in found])
        order = np.argsort(term, kind="stable")
        self.item, self.times = item[order], np.concatenate([c for _, c in found])[order]
        self.first = np.searchsorted(term[order], np.arange(n + 1))

    def enough(self, term: np.ndarray, at: np.ndarray, owner: np.ndarray, n: np.ndarray):
        """Each document's first cell, and for every cell and item, whether the cells from it
        on hold as many of the item's terms as the subsequence test asks for (never too few:
        words around a window that starts there lie in these cells)."""
        cells = -(-n // self.width)
        base = np.cumsum(cells) - cells
        every, items = int(cells.sum()), len(self.items)
        own = self.first[term + 1] > self.first[term]
        pair = np.unique(term[own] * every + base[owner[own]] + at[own] // self.width)
        t, cell = pair // max(1, every), pair % max(1, every)
        # a term counts once for the cells before its cell, back to its cell before that
        low = np.maximum(cell - self.CELLS, np.repeat(base, cells)[cell])
        low[1:] = np.where(t[1:] == t[:-1], np.maximum(low[1:], cell[:-1] + 1), low[1:])
        size = self.first[t + 1] - self.first[t]
        ends = np.cumsum(size)
        post = np.repeat(self.first[t] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        item, times, total = self.item[post], self.times[post], (every + 1) * items
        held = np.bincount(np.repeat(low, size) * items + item, times, total) - np.bincount(np.repeat(cell + 1, size) * items + item, times, total)
        return base, (np.cumsum(held.reshape(-1, items), axis=0) >= self.need - 0.5)[:every]


class Searcher:
    def __init__(self, space: Space, items: Items, p: Params):
        self.s, self.items, self.p = space, items, p
        self.n = len(space.idf)
        self.groups = [Group(np.array(group), step, steps, items, self.n, min(p.alike, p.copied)) for (step, steps), group in sorted(items.groups.items())]
        self.exact = []
        for n, group in sorted(items.exact.items()):
            key = np.array([_sequence(items.tokens[i], n)[0] for i in group])
            order = np.argsort(key, kind="stable")
            self.exact.append((n, key[order], np.array(group)[order]))

    def copies(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
        """(document, item) of the items that are matched word by word."""
        found = set()
        for n, keys, group in self.exact:
            if n > len(h):
                continue
            run = _sequence(h, n)
            at = np.flatnonzero(np.isin(run, keys))
            doc = np.searchsorted(first, at, side="right") - 1
            for a, d in zip(at[at + n <= first[doc + 1]].tolist(), doc[at + n <= first[doc + 1]].tolist()):
                for i in group[np.searchsorted(keys, run[a]) : np.searchsorted(keys, run[a], side="right")].tolist():
                    if (self.items.tokens[i] == h[a : a + n]).all():
                        found.add((d, i))
        return sorted(found)

    def windows(self, code: np.ndarray, first: np.ndarray):
        """Candidates of a run of documents: (document, item, cosine, start, end), an array each."""
        s, p = self.s, self.p
        n = np.diff(first)
        at = np.flatnonzero((code >= 0) & (code < self.n))
        owner = np.searchsorted(first, at, side="right") - 1
        terms = np.zeros(len(code) + 1, np.int64)
        terms[at + 1] = 1
        np.cumsum(terms, out=terms)
        for g in self.groups:
            base, enough = g.enough(code[at], at - first[owner], owner, n)
            some = enough.any(axis=1)
            if not some.any():
                continue
            count = np.where(n > 0, np.maximum(1, -(-n // g.step) - g.steps + 1), 0)
            doc = np.repeat(np.arange(len(n)), count)
            k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            a = first[doc] + k * g.step
            b = np.minimum(a + g.step * g.steps, first[doc + 1])
            low, _ = _around(a, b, first[doc], first[doc + 1], g.longest)
            place = base[doc] + (low - first[doc]) // g.width
            keep = np.flatnonzero(some[place] & (terms[b] > terms[a]))
            for i in range(0, len(keep), 4096):
                part = keep[i : i + 4096]
                size = terms[b[part]] - terms[a[part]]
                ends = np.cumsum(size)
                run = at[np.repeat(terms[a[part]] - (ends - size), size) + np.arange(ends[-1])]
                folded = np.add.reduceat(s.vectors[code[run]], ends - size)
                folded /= np.maximum(1e-12, np.linalg.norm(folded, axis=1, keepdims=True))
                cos = folded @ self.items.latent[g.items].T
                w, item = np.nonzero((cos >= p.cosine) & enough[place[part]])
                if len(w):
                    yield doc[part[w]], g.items[item], cos[w, item], a[part[w]], b[part[w]]

    def possible(self, code, first, doc, item, cos, a, b):
        """The candidates with as many of the item's words around as the subsequence test
        asks for."""
        least = min(self.p.alike, self.p.copied)
        here = np.zeros(len(self.s.terms.table) + 1, bool)  # the last is for other words
        ok = np.zeros(len(doc), bool)
        cut = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])))
        for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(doc)]):
            longest = max(len(self.items.codes[x]) for x in item[i:j].tolist())
            low, high = _around(a[i], b[i], first[doc[i]], first[doc[i] + 1], longest)
            around = code[low:high]
            here[around] = True
            here[-1] = False
            for k in range(i, j):
                own = self.items.codes[item[k]]
                ok[k] = np.count_nonzero(here[own]) >= least * len(own) - 1e-9
            here[around] = False
        return doc[ok], item[ok], cos[ok], a[ok], b[ok]

    def find(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """Leaks of a run of documents: (document, item, cosine, share of the item in the
        common subsequence, share of its answer)."""
        p = self.p
        h, first = words(data, off)
        if not len(h) or not len(self.items.ids):
            return []
        out = [(d, i, 1.0, 1.0, 1.0) for d, i in self.copies(h, first)]
        code = self.s.terms.lookup(h)
        found = [self.possible(code, first, *x) for x in self.windows(code, first)]
        if found:
            doc, item, cos, a, b = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((a, -cos, item, doc))
            leaked = None
            for d, i, c, a, b in zip(*(x[order].tolist() for x in (doc, item, cos, a, b))):
                if (d, i) == leaked:
                    continue  # by a window of higher cosine
                tokens = self.items.tokens[i]
                low, high = _around(a, b, first[d], first[d + 1], len(tokens))
                hit = common_subsequence(tokens, h[low:high], min(p.alike, p.copied))
                lcs, answer = float(hit.mean()), float(hit[-p.answer_words :].mean())
                if lcs >= p.copied or (lcs >= p.alike and answer >= p.answer):
                    out.append((d, i, c, lcs, answer))
                    leaked = (d, i)
        return sorted(out)


def _around(a, b, low, high, length: int):
    """The words that a window is compared with, within its document."""
    reach = np.maximum(length, b - a)
    return np.maximum(low, b - 1 - reach - reach // 2), np.minimum(high, a + reach + reach // 2)


def _leaks_arrow(space, block, p: Params):
    def run(batches):
        searcher = Searcher(space.value, block.value, p)
        names = searcher.items.ids
        for batch in batches:
            rows = []
            for i, _, data, off in text_slices(batch.column(1)):
                rows += [(batch.column(0)[i + d].as_py(), names[k], *rest) for d, k, *rest in searcher.find(data, off)]
            kinds = [batch.column(0).type, pa.int64(), *[pa.float64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)], LEAKS)

    return run


LEAKS = ["doc_id", "item_id", "cosine", "common", "answer"]


def _clean_arrow(space, block, p: Params, text: str):
    def run(batches):
        searcher = Searcher(space.value, block.value, p)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for i, _, data, off in text_slices(batch.column(batch.schema.get_field_index(text))):
                keep[[i + d for d, *_ in searcher.find(data, off)]] = False
            yield batch.filter(pa.array(keep))

    return run


def _blocks(docs: DataFrame, benchmark: DataFrame, p: Params):
    """Broadcasts of the latent space, one for all, and of the items, ``block`` at a time."""
    context, space, held = docs.sparkSession.sparkContext, None, []
    for item in _items(benchmark):
        if space is None:
            fitted = fit(docs, benchmark, p)
            space = context.broadcast(fitted)
        held.append(item)
        if len(held) == p.block:
            yield space, context.broadcast(place_items(held, fitted, p))
            held = []
    if held:
        yield space, context.broadcast(place_items(held, fitted, p))


def leaks(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer) of every leak of an item into a document."""
    spark, found = docs.sparkSession, None
    docs = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, cosine double, common double, answer double"
    for space, block in _blocks(docs, benchmark, p):
        part = docs.mapInArrow(tidy(_leaks_arrow(space, block, p)), schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, whole, that no benchmark item leaked into."""
    clean = docs.select(whole_rows(docs), F.col("text"))
    schema = clean.schema
    for space, block in _blocks(docs, benchmark, p):
        clean = clean.mapInArrow(tidy(_clean_arrow(space, block, p, "text")), schema)
    return unpacked(clean, docs.columns)

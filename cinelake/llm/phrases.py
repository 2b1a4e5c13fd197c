"""Phrase collocations by broadcast double-array tries.

Texts become a stream of bytes: lower-case words with one byte behind each, a space within a piece
and a line feed at its end.  Two passes over all texts and one over what they leave follow.

1. Bounds.  Every phrase of 1 to ``longest`` words falls into one of ``buckets`` by a hash; tasks count
   them by sorting, the counts are dealt by ranges of buckets and summed, and a bucket is hot from ``least`` on.
   The hot buckets become a filter of ``BITS`` bits for each, with two probes.
2. Windows.  A phrase can reach ``least`` only if its bucket is hot and, by the Apriori
   rule, the two phrases one word shorter that it holds are candidates themselves.  From each word the longest
   candidate that begins there is a window; tasks write their distinct windows and how often they hold each, dealt into
   shards by language and first two words (single words: by the word).  The phrases with which windows begin are the
   candidates: a superset of the frequent ones, whatever collides.
3. Counts.  Each shard's candidates become a double-array trie over bytes, built in a task and broadcast.  The
   states of many windows of a shard advance together, byte level by byte level; where a
   word ends in an accepting state, the window's number is added.  The tasks' counts are summed.  No count
   comes from a hash.

Scores, covers and the ranking are DataFrame operations on the phrases that are frequent.

What a task holds is bounded by parameters (batches by ``BATCH``), the filter by the number of frequent phrases.  Tries of up to ``HOLD`` bytes
in sum are broadcast at once; where the candidates need more, there are more such groups, each of which reads the windows of
its own shards only (they are written in the order of shards).  They pass the driver one by one, which hands the
memory back after each.

Defined cases: null text is empty, null lang is ``und``; repeated rows count as often as they stand
there; no word crosses a document; an empty table gives no phrases; texts of any length are read whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.bytebpe import runs
from cinelake.llm.common import hand_back, lower_ascii, mix64, RollingHash, small_batches, text_slices, tidy
from cinelake.session import materialize

#: Hash buckets of the bounds, for each length of phrases, and how many are counted together.
BUCKETS, _BLOCK = 1 << 42, 1 << 32
#: Bits of the filter for each hot bucket.
BITS = 20
#: Bytes of phrases in one trie, and bytes of tries that a task holds at a time.
TRIE, HOLD = 1 << 21, 32 << 20
#: Bytes of text read at a time, and bucket numbers or windows a task holds before it hands them on.
RUN, HELD = 1 << 19, 1 << 19
#: Bytes of windows read at a time.
BLOBS = 1 << 20
#: Bytes of rows that a task gets in one batch, and of the row groups that windows are written in: rows of windows are
#: large, and both would hold a task's whole share of them.
BATCH = 1 << 22

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
_INK = ~(_GAP | _BREAK)
_LOWER = lower_ascii(np.arange(256, dtype=np.uint8))


class Stream:
    """The words of a run of documents: ``data`` (each word and a space or line feed), where
    words ``start`` and ``end``, the ``doc`` of each, and whether it is the ``last`` of its piece."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        ink = _INK[raw]
        head = np.zeros(len(raw) + 1, bool)
        head[off[:-1]] = True
        before = np.empty(len(raw), bool)
        before[:1], before[1:] = False, ink[:-1]
        start = np.flatnonzero(ink & (~before | head[:-1]))
        after = np.empty(len(raw), bool)
        after[-1:], after[:-1] = False, ink[1:]
        end = np.flatnonzero(ink & (~after | head[1:])) + 1
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(start, off)))
        n = end - start
        breaks = np.flatnonzero(_BREAK[raw])
        self.last = np.ones(len(start), bool)
        if len(start) > 1:
            self.last[:-1] = (np.searchsorted(breaks, start[1:]) > np.searchsorted(breaks, end[:-1])) | (self.doc[1:] != self.doc[:-1])
        self.start = np.cumsum(n + 1) - (n + 1)
        self.end = self.start + n
        self.inner = np.concatenate([[0], np.cumsum(self.last)])
        word = np.ones(int(n.sum()) + len(n), bool)
        word[self.end] = False
        self.data = np.empty(len(word), np.uint8)
        self.data[word] = _LOWER[raw[ink]]
        self.data[self.end] = np.where(self.last, 10, 32)

    def phrases(self, length: int) -> np.ndarray:
        """Word numbers at which a phrase of that many words begins."""
        n = len(self.start) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.inner[length - 1 : length - 1 + n] == self.inner[:n])

    def buckets(self, roll: RollingHash, salt: np.ndarray, at: np.ndarray, length: int, buckets: int) -> np.ndarray:
        return (roll.of(self.start[at], self.end[at + length - 1]) ^ salt[self.doc[at]]) % np.uint64(buckets)


def _streams(batches):
    """(stream, languages of its documents as bytes) for all rows (lang, text)."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for i, j, data, off in text_slices(batch.column(1), RUN):
            yield Stream(data, off), [x.encode() for x in langs[i:j]]


def _salts(langs: list[bytes]) -> np.ndarray:
    """A hash of each document's language."""
    data = np.frombuffer(b"".join(langs), np.uint8)
    stop = np.cumsum([len(x) for x in langs]) if langs else np.zeros(0, np.int64)
    begin = np.concatenate([[0], stop[:-1]]).astype(np.int64)
    return mix64(RollingHash(data).of(begin, stop) + np.uint64(1))


# --- pass 1: bounds -----------------------------------------------------------------------------


def _bounds_arrow(longest: int, least: int, buckets: int):
    """Rows (level, block, places, counts) of buckets, counts up to ``least``; words and their bytes of each
    language as level 0."""
    most, kind = HELD, np.min_scalar_type(least)

    def rows(level: int, held: list):
        bucket = np.sort(np.concatenate(held))
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        n = np.minimum(np.diff(np.append(first, len(bucket))), least).astype(kind)
        bucket = bucket[first]
        block = bucket // np.uint64(_BLOCK)
        cut = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
        m = len(cut) - 1
        cols = [pa.array(np.full(m, level, np.int32)), pa.array(block[cut[:-1]].astype(np.int64))]
        cols += [_packed((bucket % np.uint64(_BLOCK)).astype(np.uint32), cut), _packed(n, cut)]
        return pa.RecordBatch.from_arrays([*cols, pa.nulls(m, pa.string()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names)

    names = ["level", "block", "place", "count", "lang", "n", "size"]

    def run(batches):
        held: dict[int, list] = {k: [] for k in range(1, longest + 1)}
        size = dict.fromkeys(held, 0)
        total: dict[bytes, np.ndarray] = {}
        for s, langs in _streams(batches):
            n = np.bincount(s.doc, minlength=len(langs)), np.bincount(s.doc, s.end - s.start, minlength=len(langs))
            for lang, x in zip(langs, np.stack(n, axis=1).astype(np.int64)):
                total[lang] = total.get(lang, 0) + x
            roll, salt = RollingHash(s.data), _salts(langs)
            for k in held:
                held[k].append(s.buckets(roll, salt, s.phrases(k), k, buckets))
                size[k] += len(held[k][-1])
                if size[k] > most:
                    yield rows(k, held[k])
                    held[k], size[k] = [], 0
        for k in held:
            if size[k]:
                yield rows(k, held[k])
        if total:
            m = len(total)
            cols = [pa.array([0] * m, pa.int32()), pa.array([-1] * m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())]
            cols += [pa.array([k.decode() for k in total]), *(pa.array([int(x[i]) for x in total.values()], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _packed(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of values[cut[i]:cut[i + 1]] for each i."""
    off = (cut * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))])


def _hot_arrow(least: int):
    """The hot buckets (places, and their number ``n``) of each (level, block), whose rows come one after the other; level 0 as
    it stands."""
    kind = np.min_scalar_type(least)

    def close(key, held):
        # a place and a count in one number each
        both = np.sort(np.concatenate([p.astype(np.uint64) << np.uint64(32) | n for p, n in held]))
        place = (both >> np.uint64(32)).astype(np.uint32)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        hot = place[first[np.add.reduceat(both & np.uint64(0xFFFFFFFF), first) >= np.uint64(least)]]
        return [*key, hot.tobytes(), None, len(hot), None]

    def out(rows):
        kinds = pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["level", "block", "hot", "lang", "n", "size"])

    def run(batches):
        key, held = None, []
        for batch in batches:
            for level, block, place, n, *total in zip(*(batch.column(i) for i in range(7))):
                if (level.as_py(), block.as_py()) != key:
                    if held:
                        yield out([close(key, held)])
                    key, held = (level.as_py(), block.as_py()), []
                if key[0]:
                    held.append((np.frombuffer(place.as_buffer(), np.uint32), np.frombuffer(n.as_buffer(), kind)))
                else:
                    yield out([[0, -1, None, *(x.as_py() for x in total)]])
        if held:
            yield out([close(key, held)])

    return run


def _spots(place: np.ndarray, bits: int, width: int):
    """The two bits that stand for each place of a block of ``width`` buckets."""
    place = place.astype(np.uint64)
    one = place * np.uint64(bits) // np.uint64(width)
    two = ((place * np.uint64(0x9E3779B1) + np.uint64(1)) & np.uint64(0xFFFFFFFF)) * np.uint64(bits) >> np.uint64(32)
    return one.astype(np.int64), two.astype(np.int64)


class Filter:
    """Which buckets may be hot: ``bits`` bits for each block of ``width`` buckets, two of them for each hot one."""

    def __init__(self, hot: int, buckets: int):
        blocks = -(-buckets // _BLOCK)
        self.width = min(buckets, _BLOCK)
        self.bits = 8 * max(1, -(-BITS * hot // (8 * blocks)))
        self.map = np.zeros(blocks * self.bits // 8, np.uint8)

    def has(self, bucket: np.ndarray) -> np.ndarray:
        one, two = _spots(bucket % np.uint64(_BLOCK), self.bits, self.width)
        base = (bucket // np.uint64(_BLOCK)).astype(np.int64) * self.bits
        found = self._bit(base + one)
        at = np.flatnonzero(found)
        found[at] = self._bit(base[at] + two[at])
        return found

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.map[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _filter_arrow(sizes: dict):
    """Each block's part of the filters (``sizes``: bits and width by level)."""

    def run(batches):
        for batch in batches:
            for level, block, hot in zip(*(batch.column(i).to_pylist() for i in range(3))):
                bits, width = sizes[level]
                on = np.zeros(bits, bool)
                for at in _spots(np.frombuffer(hot, np.uint32), bits, width):
                    on[at] = True
                cols = [pa.array([level], pa.int32()), pa.array([block], pa.int64()), pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["level", "block", "bits"])

    return run


def filters(bounds: DataFrame, hot: dict[int, int], buckets: int) -> dict[int, Filter]:
    """For each length the filter of its hot buckets, of which there are so many."""
    found = {k: Filter(n, buckets) for k, n in hot.items()}
    sizes = {k: (f.bits, f.width) for k, f in found.items()}
    rows = bounds.filter("level > 0 and n > 0").select("level", "block", "hot").mapInArrow(tidy(_filter_arrow(sizes)), "level int, block long, bits binary")
    for level, block, bits in rows.collect():
        at = block * found[level].bits // 8
        found[level].map[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    return found


# --- pass 2: windows --------------------------------------------------------------------------------


def _windows_arrow(shared, longest: int, buckets: int, shards: int):
    """Rows (shard, lang, windows, counts): distinct windows of a task, each with a line feed at its end."""
    most = HELD

    def dealt(table: pa.Table, names: list[bytes]):
        table = table.combine_chunks()
        window, lang = table["w"].combine_chunks(), table["lang"].to_numpy()
        salt, shard = _salts(names), np.empty(len(lang), np.int64)
        for i, j, data, off in text_slices(window, RUN):
            ends = np.flatnonzero((data == 32) | (data == 10))
            first = np.searchsorted(ends, off[:-1])
            head = ends[first + (data[ends[first]] == 32)]  # behind one word or two
            shard[i:j] = (mix64((RollingHash(data).of(off[:-1], head) ^ salt[lang[i:j]]) + np.uint64(1)) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((lang, shard))
        window, lang, shard = window.take(pa.array(order)), lang[order], shard[order]
        new = (lang[1:] != lang[:-1]) | (shard[1:] != shard[:-1])
        cut = np.append(np.flatnonzero(np.append(True, new)), len(lang))
        off = np.frombuffer(window.buffers()[1], np.int32)[cut]
        data = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(off), window.buffers()[2]])
        cols = [pa.array(shard[cut[:-1]]), pa.array([names[i].decode() for i in lang[cut[:-1]]], pa.string()), data]
        return pa.RecordBatch.from_arrays([*cols, _packed(table["n"].to_numpy()[order], cut)], ["shard", "lang", "data", "n"])

    def run(batches):
        hot = shared.value
        codes: dict[bytes, int] = {}
        held, size = [], 0
        for s, langs in _streams(batches):
            roll, salt = RollingHash(s.data), _salts(langs)
            reach = np.zeros(len(s.start), np.int8)  # words of the longest candidate from each word on
            for k in range(1, longest + 1):
                at = s.phrases(k)
                if k > 1:
                    at = at[(reach[at] == k - 1) & (reach[at + 1] >= k - 1)]
                reach[at[hot[k].has(s.buckets(roll, salt, at, k, buckets))]] = k
            code = np.array([codes.setdefault(x, len(codes)) for x in langs], np.int32)[s.doc]
            whole = s.data.copy()
            whole[s.end] = 10
            words = pa.Array.from_buffers(pa.binary(), len(s.start), [None, pa.py_buffer(np.append(s.start, len(whole)).astype(np.int32)), pa.py_buffer(whole)])
            one, several = np.flatnonzero(reach > 0), np.flatnonzero(reach > 1)
            stop = s.end[several + reach[several] - 1] + 1
            for at, w in ((one, words.take(pa.array(one))), (several, _joined(s.data, s.start[several], stop))):
                held.append(pa.table({"lang": code[at], "w": w, "n": np.ones(len(at), np.int64)}))
                size += cost(held[-1])
            if size > most:
                held = [grouped(held)]
                size = cost(held[0])
                if size > most // 2:
                    yield dealt(held[0], list(codes))
                    held, size = [], 0
        if size:
            yield dealt(grouped(held), list(codes))

    def grouped(held: list) -> pa.Table:
        table = pa.concat_tables(held).group_by(["lang", "w"], use_threads=False).aggregate([("n", "sum")])
        return table.rename_columns({"n_sum": "n"})

    def cost(table: pa.Table) -> int:
        return table.num_rows + table["w"].nbytes // 64

    return run


def _joined(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """data[start:stop] for each, with a line feed as its last byte."""
    n = stop - start
    off = np.concatenate([[0], np.cumsum(n)])
    out = data[runs(start, n)]
    out[off[1:] - 1] = 10
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(out)])


def _pieces(batch: pa.RecordBatch, i: int, j: int):
    """Rows i to j in runs of some ``BLOBS`` bytes of windows: (first row, end row, bytes, each row's bytes)."""
    size = pc.binary_length(batch.column(2)).to_numpy()
    while i < j:
        k = i + max(1, int(np.searchsorted(np.cumsum(size[i:j]), BLOBS, side="right")))
        yield i, k, np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column(2).slice(i, k - i)]), size[i:k]
        i = k


def _changes(*columns: list) -> list[int]:
    """Where rows begin that differ from the row before, and the end."""
    rows = list(zip(*columns))
    return [i for i in range(len(rows)) if not i or rows[i] != rows[i - 1]] + [len(rows)]


def _candidates_arrow(longest: int):
    """The phrases (shard, lang, phrase, words) with which windows begin; the rows of a (shard, lang) come one after the other."""

    def close(shard: int, lang: str, window: pa.Array):
        off = np.frombuffer(window.buffers()[1], np.int32)[: len(window) + 1].astype(np.int64)
        data = np.frombuffer(window.buffers()[2], np.uint8)
        ends = np.flatnonzero((data == 32) | (data == 10))
        first = np.searchsorted(ends, off)
        words = np.diff(first)
        for k in range(1, longest + 1):
            at = np.flatnonzero((words >= k) & ((words == 1) == (k == 1)))
            phrase = _joined(data, off[at], ends[first[at] + k - 1] + 1).unique()
            for i in range(0, len(phrase), 1 << 16):
                part = pc.binary_slice(phrase.slice(i, 1 << 16), 0, -1).cast(pa.string())
                cols = [pa.array(np.full(len(part), shard)), pa.array([lang] * len(part), pa.string()), part, pa.array(np.full(len(part), k, np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["shard", "lang", "phrase", "words"])

    def run(batches):
        key, found = None, None
        for batch in batches:
            shard, lang = (batch.column(x).to_pylist() for x in (0, 1))
            cut = _changes(shard, lang)
            for i, j in zip(cut, cut[1:]):
                if (shard[i], lang[i]) != key:
                    if key is not None:
                        yield from close(*key, found)
                    key, found = (shard[i], lang[i]), pa.array([], pa.binary())
                for _, _, data, _ in _pieces(batch, i, j):
                    off = np.append(0, np.flatnonzero(data == 10) + 1).astype(np.int32)
                    more = pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(data)])
                    found = pa.chunked_array([found, more.unique()]).unique()
        if key is not None:
            yield from close(*key, found)

    return run


# --- double-array tries -----------------------------------------------------------------------------


class Trie:
    """A double array over bytes.  From state s, byte c leads to t = base[s] + c if check[t] = s.
    State 0 is the root; ``ends`` are the accepting states, ascending, and ``keys`` the numbers of their keys."""

    def __init__(self, base: np.ndarray, check: np.ndarray, ends: np.ndarray, keys: np.ndarray):
        self.base, self.check, self.ends, self.keys = base, check, ends, keys

    def accepted(self, state: np.ndarray) -> np.ndarray:
        """Numbers of the keys that end in these states (other states left out)."""
        if not len(self.ends):
            return self.ends
        at, found = self.endings(state)
        return self.keys[at[found]]

    def endings(self, state: np.ndarray):
        """Place of each state in ``ends``, and whether it is there."""
        at = np.minimum(np.searchsorted(self.ends, state), len(self.ends) - 1)
        return at, self.ends[at] == state

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        to = self.base[state] + byte
        return np.where(self.check[to] == state, to, -1)

    def walk(self, text: bytes) -> int:
        state = 0
        for c in text:
            to = int(self.base[state]) + c
            if self.check[to] != state:
                return -1
            state = to
        return state


def _nodes(flat: np.ndarray, off: np.ndarray):
    """Nodes of the trie of sorted distinct keys, level by level: parent, byte, and the
    node at which each key ends.  Node 0 is the root; children stand side by side."""
    n = np.diff(off).astype(np.int32)
    live = np.arange(len(n), dtype=np.int32)
    node = np.zeros(len(n), np.int32)
    last = np.zeros(len(n), np.int32)
    parents, signs, made, depth = [np.array([-1], np.int32)], [np.zeros(1, np.uint8)], 1, 0
    while len(live):
        ends = n[live] == depth
        last[live[ends]] = node[ends]
        live, node = live[~ends], node[~ends]
        if not len(live):
            break
        c = flat[off[live] + depth]
        new = np.ones(len(live), bool)
        new[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])
        parents.append(node[new])
        signs.append(c[new])
        node = (made - 1 + np.cumsum(new)).astype(np.int32)
        made += int(new.sum())
        depth += 1
    return np.concatenate(parents), np.concatenate(signs), last


def build(flat: np.ndarray, off: np.ndarray, seed: int = 5) -> Trie:
    """Trie of sorted distinct keys (bytes, one after the other, and their bounds).  Nodes with
    many children are placed first; those with equally many propose places together, and
    whoever claims only free ones first gets them."""
    parent, sign, last = _nodes(flat, off)
    count = np.bincount(parent[1:], minlength=len(parent)).astype(np.int16)
    first = np.zeros(len(parent), np.int32)
    heads = np.flatnonzero(parent[1:] != parent[:-1]) + 1
    first[parent[heads]] = heads
    rng = np.random.default_rng(seed)
    used = np.zeros(512 + int(1.1 * len(parent)), bool)
    used[:256] = True  # so that no base is negative
    claim = np.full(len(used), -1, np.int32)
    base = np.zeros(len(parent), np.int32)
    for m in np.unique(count[count > 0])[::-1].tolist():
        todo = np.flatnonzero(count == m)
        while len(todo):
            free = np.flatnonzero(~used[:-256]).astype(np.int32)
            if len(free) < len(todo):
                more = max(512, 2 * len(todo) * m)
                used, claim = np.append(used, np.zeros(more, bool)), np.append(claim, np.full(more, -1, np.int32))
                continue
            lost = []
            tries = 0 if m == 1 else len(todo)
            for i in range(0, len(todo), 1 << 18):  # so many nodes propose at a time
                part = todo[i : i + (1 << 18)]
                spread = sign[first[part][:, None] + np.arange(m)].astype(np.int32)
                place = (free[i : i + len(part)] if m == 1 else rng.choice(free, len(part))) - spread[:, 0]
                slots = place[:, None] + spread
                order = np.arange(len(part), dtype=np.int32)[::-1]
                claim[slots[order]] = order[:, None]  # the first of the list has the last word
                won = ~used[slots].any(axis=1) & (claim[slots] == np.arange(len(part))[:, None]).all(axis=1)
                claim[slots] = -1
                used[slots[won]] = True
                base[part[won]] = place[won]
                lost.append(part[~won])
            todo = np.concatenate(lost)
            if len(todo) * 20 > tries * 19 > 0:  # hardly any found a place
                more = max(512, len(todo) * m)
                used, claim = np.append(used, np.zeros(more, bool)), np.append(claim, np.full(more, -1, np.int32))
    del claim, first, count
    state = np.zeros(len(parent), np.int32)
    state[1:] = base[parent[1:]] + sign[1:]
    size = len(used) + 256
    double, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    double[state] = base
    check[state[1:]] = state[parent[1:]]
    order = np.argsort(state[last])
    return Trie(double, check, state[last][order], order.astype(np.int32))


def _build_arrow(table: pa.Table) -> pa.Table:
    """One trie of the candidates (id, lang, phrase) of a shard: its arrays, and the ids of its keys."""
    # single words and phrases of several have roots of their own; no phrase holds a line feed, so no two keys are alike
    mark = pc.if_else(pc.greater(table["words"], 1), b"2", b"1").cast(pa.binary())
    phrase = pc.binary_join_element_wise(mark, table["phrase"].cast(pa.binary()), b"")
    keys = pc.binary_join_element_wise(table["lang"].cast(pa.binary()), phrase, b"\n")
    order = pc.sort_indices(keys)
    keys = keys.take(order).combine_chunks()
    ids = table["id"].take(order).combine_chunks().to_numpy()
    off = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    trie = build(np.frombuffer(keys.buffers()[2], np.uint8), off)
    arrays = {"base": trie.base, "check": trie.check, "ends": trie.ends, "ids": ids[trie.keys]}
    return pa.table({"shard": table["shard"].slice(0, 1), **{k: pa.array([x.tobytes()], pa.binary()) for k, x in arrays.items()}})


def count_keys(trie: Trie, data: np.ndarray, at: np.ndarray, state: np.ndarray, n: np.ndarray, counts: np.ndarray) -> None:
    """Add to ``counts``, at the place in ``trie.ends`` of each key with which windows begin, how often there are these
    windows (``n``).  They begin ``at`` these bytes and their walks in these states: all of them together."""
    live = np.flatnonzero(state >= 0)
    at, state, n = at[live], state[live], n[live]
    while len(at):
        c = data[at]
        ends = np.flatnonzero((c == 32) | (c == 10))
        if len(ends):
            key, found = trie.endings(state[ends])
            np.add.at(counts, key[found], n[ends[found]])
        state = trie.step(state, c)
        go = np.flatnonzero((state >= 0) & (c != 10))
        state, at, n = state[go], at[go] + 1, n[go]


def _count_arrow(shared: dict):
    """Counts of the keys of some shards' tries (shard to broadcast arrays) in windows, which come in the order of shards."""

    def run(batches):
        tries, ids, counts = {}, {}, {}
        for i, b in shared.items():
            ends = np.frombuffer(b.value["ends"], np.int32)
            tries[i] = Trie(*(np.frombuffer(b.value[k], np.int32) for k in ("base", "check")), ends, np.arange(len(ends), dtype=np.int32))
            ids[i] = np.frombuffer(b.value["ids"], np.int64)
            counts[i] = np.zeros(len(ends), np.int64)
        for batch in batches:
            shard = batch.column(0).to_pylist()
            cut = _changes(shard)
            for first, end in zip(cut, cut[1:]):
                trie, sums = tries[shard[first]], counts[shard[first]]
                for i, j, data, size in _pieces(batch, first, end):
                    langs = batch.column(1).slice(i, j - i).to_pylist()
                    n = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(3).slice(i, j - i)])
                    at = np.append(0, np.flatnonzero(data == 10)[:-1] + 1)
                    several = np.add.reduceat(data == 32, at, dtype=np.int64) > 0
                    roots = {x: [trie.walk(x.encode() + mark) for mark in (b"\n1", b"\n2")] for x in set(langs)}
                    row = np.repeat(np.arange(j - i), np.diff(np.searchsorted(at, np.append(0, np.cumsum(size)))))
                    count_keys(trie, data, at, np.array([roots[x] for x in langs], np.int32)[row, several.astype(np.int64)], n, sums)
        for i in tries:
            hit = np.flatnonzero(counts[i])
            for j in range(0, len(hit), 1 << 16):
                part = hit[j : j + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[i][part]), pa.array(counts[i][part])], ["id", "n"])

    return run


# --- the operator -------------------------------------------------------------------------------------


def frequent(docs: DataFrame, longest: int = 3, least: int = 10, buckets: int = BUCKETS, trie: int = TRIE, hold: int = HOLD):
    """((lang, phrase, words, f) of all phrases of up to ``longest`` words with f >= ``least``, (lang, n) of all
    words).  Both are written tables."""
    with small_batches(docs.sparkSession, BATCH):
        return _frequent(docs, longest, least, buckets, trie, hold)


def _frequent(docs: DataFrame, longest: int, least: int, buckets: int, trie: int, hold: int):
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "level int, block long, place binary, count binary, lang string, n long, size long"
    rows = src.mapInArrow(tidy(_bounds_arrow(longest, least, buckets)), schema).repartition("level", "block").sortWithinPartitions("level", "block")
    schema = "level int, block long, hot binary, lang string, n long, size long"
    bounds = materialize(rows.mapInArrow(tidy(_hot_arrow(least)), schema), "phrase-bounds")
    sums = {r[0]: r for r in bounds.groupBy("level").agg(F.sum("n"), F.sum("size")).collect()}
    found = {k: sums[k][1] if k in sums else 0 for k in range(1, longest + 1)}
    # the candidates' bytes, if their words are as long as all words: what a trie holds need not be exact
    size = sum(k * n for k, n in found.items()) * (1 + sums[0][2] / max(1, sums[0][1]) if sums else 0)
    shards = max(1, -(-int(size) // trie))
    hot = sc.broadcast(filters(bounds, found, buckets))
    windows = src.mapInArrow(tidy(_windows_arrow(hot, longest, buckets, shards)), "shard long, lang string, data binary, n binary")
    groups = {"parquet.block.size": BATCH, "parquet.block.size.row.check.min": 4, "parquet.page.size.row.check.min": 4}
    windows = materialize(windows.sortWithinPartitions("shard"), "phrase-windows", groups)
    hot.unpersist()
    dealt = windows.select("shard", "lang", "data").repartition("shard", "lang").sortWithinPartitions("shard", "lang")
    dealt = dealt.mapInArrow(tidy(_candidates_arrow(longest)), "shard long, lang string, phrase string, words int")
    candidates = materialize(dealt.withColumn("id", F.monotonically_increasing_id()), "phrase-candidates")
    tries = candidates.groupBy("shard").applyInArrow(_build_arrow, "shard long, base binary, check binary, ends binary, ids binary")
    tries = materialize(tries.withColumn("size", F.octet_length("base") + F.octet_length("check") + F.octet_length("ends") + F.octet_length("ids")), "tries")
    counted, group, held = [candidates.select("id", F.lit(0).cast("long").alias("n")).limit(0)], {}, 0
    sizes = sorted(tuple(r) for r in tries.select("shard", "size").collect())  # a row for each trie
    for i, (shard, size) in enumerate(sizes):
        row = tries.filter(F.col("shard") == shard).first()
        group[shard] = sc.broadcast(row.asDict())
        del row
        hand_back(docs.sparkSession)
        held += size
        if i + 1 == len(sizes) or held + sizes[i + 1][1] > hold:
            mine = windows.filter(F.col("shard").between(min(group), max(group)))
            counted.append(materialize(mine.mapInArrow(tidy(_count_arrow(group)), "id long, n long"), "phrase-counts"))
            for b in group.values():
                b.destroy(blocking=True)
            hand_back(docs.sparkSession)
            group, held = {}, 0
    total = reduce(DataFrame.unionByName, counted).groupBy("id").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    phrases = materialize(candidates.join(total, "id").select("lang", "phrase", "words", "f"), "phrases")
    return phrases, bounds.filter("level = 0").groupBy("lang").agg(F.sum("n").alias("n"))


def _part(first: Column, last: Column) -> Column:
    """Words ``first`` to ``last`` (from 1) of the list ``w``, as a phrase."""
    return F.array_join(F.slice("w", first, last - first + 1), " ")


def ranked(phrases: DataFrame, totals: DataFrame, longest: int = 3, cover: int = 50, top: int = 2000) -> DataFrame:
    """The ranking of ``collocations`` from the two tables of ``frequent``."""
    long = phrases.filter("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = long.select("lang", "phrase", "words", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("words")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    # products in 38 digits; the quotient is at most 1000000
    score = F.expr("cast(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as bigint)")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    # the most frequent longer candidate around each phrase
    inner = long.filter("words > 2").select("lang", "words", F.col("f").alias("around"), "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    inner = inner.select("lang", "around", "m", "w", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("i"))
    inner = inner.select("lang", "around", _part(F.col("i"), F.col("i") + F.col("m") - 1).alias("phrase")).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = lowest.join(inner, ["lang", "phrase"], "left").filter((F.col("around").isNull()) | (100 * F.col("around") < cover * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``longest`` words; see
    the contract of op13."""
    phrases, totals = frequent(docs, longest, least)
    return ranked(phrases, totals, longest, cover, top)


ORACLE_SQL = r"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
    FROM documents
), pieces AS (
    SELECT lang, d, p, [x FOR x IN regexp_split_to_array(pieces[p], '[\x20\x09]+') IF x <> ''] AS w
    FROM (SELECT lang, d, pieces, unnest(range(1, len(pieces) + 1)) AS p FROM docs)
), words AS (
    SELECT lang, d, p, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), grams AS (
    SELECT lang, list_slice(w, i, i + m - 1) AS g FROM words, (VALUES (1), (2), (3)) AS lengths(m) WHERE i + m - 1 <= len(w)
), f AS (
    SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g
), n AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang
), candidates AS (
    SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 10
), cuts AS (
    SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
    JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g))
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), covered AS (
    SELECT lang, g, max(a) AS around FROM (
        SELECT lang, list_slice(g, 1, 2) AS g, a FROM candidates WHERE len(g) = 3
        UNION ALL SELECT lang, list_slice(g, 2, 3), a FROM candidates WHERE len(g) = 3
    ) GROUP BY lang, g
), kept AS (
    SELECT w.lang, array_to_string(w.g, ' ') AS phrase, w.a, w.l, w.r, w.score
    FROM lowest w LEFT JOIN covered c ON c.lang = w.lang AND c.g = w.g
    WHERE c.around IS NULL OR 100 * c.around < 50 * w.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank,
    k.phrase, k.a, k.l, k.r, n.n, k.score::BIGINT AS score
FROM kept k JOIN n ON n.lang = k.lang
QUALIFY rank <= 2000
"""

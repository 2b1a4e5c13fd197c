"""SentencePiece (merge type) encoding with seeded merge-dropout, and lossless decoding.

The vocabulary file of a trained tokenizer gives pieces and scores; nothing is trained here.
A text's spaces become U+2581, with one in front.  It is cut into chunks in front of each run of spaces,
over which no piece reaches.  In each chunk an agenda holds the neighbouring symbols that form a
piece, best score first, then leftmost.  A candidate that comes up is skipped if a keyed hash
of seed, document, place of the chunk, place in the chunk and piece falls under the dropout rate, else merged; merging puts
the new neighbours on the agenda.  What is no piece in the end is written as bytes.

Every occurrence of a chunk draws its own skips, so a word has as many segmentations across a corpus as
its merges allow, always alike on a rerun.  A bounded memo keeps, for each distinct chunk, the ids without
dropout and the candidates on the way to them: an occurrence that skips none of these has these ids.  The
others are merged for many occurrences at once, each round in arrays.  A literal U+2581 is written as bytes, so
decoding is exact for every text.

Defined cases: null and empty texts give no ids and decode to the empty text; texts of any
length are encoded whole; repeated rows (same doc_id) get the same ids; a null doc_id counts
as 0 in the key, an id that is no whole number as its hash.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.bytebpe import runs
from cinelake.llm.common import mix64, RollingHash, row_key, text_slices, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_M = (1 << 64) - 1
_LITERAL = SPACE.encode()
#: Distinct chunks that the memo holds before it starts anew.
MEMO = 1 << 18
#: Bytes of text encoded at once.
SLAB = 1 << 20
#: Characters of a chunk in the array form.
WIDE = 40
NONE = 1 << 30


@dataclass(frozen=True)
class Params:
    dropout: float = 0.1
    seed: int = 17


@dataclass
class Vocabulary:
    ids: dict[str, int]  # pieces that merges can form
    pairs: dict[int, int]  # left id << 32 | right id -> place of their merge in the order of scores
    merged: list[int]  # id of the piece at each place
    pair_keys: np.ndarray  # the pairs as a hash table, and their places
    pair_places: np.ndarray
    merged_array: np.ndarray
    char: np.ndarray  # id of each single character, -1 for none
    byte: list[int]  # id of each byte's piece
    surface: bytes  # what the ids decode to, one after the other
    place: np.ndarray  # where each id's surface begins


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    """First slot of each pair in a table of ``size`` (a power of two)."""
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _table(keys: np.ndarray, places: np.ndarray):
    """Pairs and their places in an open table with linear probing, a quarter full at most; -1: empty."""
    size = 1 << max(4, (4 * len(keys)).bit_length())
    table, out = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    todo, slot = np.arange(len(keys)), _slot(keys, size)
    while len(todo):
        s = slot[todo]
        free = table[s] < 0
        table[s[free]] = keys[todo[free]]
        mine = table[s] == keys[todo]
        out[s[mine]] = places[todo[mine]]
        todo = todo[~mine]
        slot[todo] = (slot[todo] + 1) & (size - 1)
    return table, out


def load(path: str = MODEL) -> Vocabulary:
    """Pieces of a vocabulary file (read on the driver and sent to the tasks)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, byte, surface = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            b = int(piece[3:5], 16)
            byte[b] = i
            surface.append(bytes([b]))
        elif sp.is_control(i) or sp.is_unknown(i):
            surface.append(b"")
        else:
            ids[piece] = i
            surface.append(piece.replace(SPACE, " ").encode())
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece} reaches over the start of a chunk")
    place = np.concatenate([[0], np.cumsum([len(s) for s in surface])])
    merged = sorted((i for p, i in ids.items() if len(p) > 1), key=lambda i: (-sp.get_score(i), i))
    order = {i: n for n, i in enumerate(merged)}
    pairs = {
        ids[p[:k]] << 32 | ids[p[k:]]: order[i]
        for p, i in ids.items()
        for k in range(1, len(p))
        if p[:k] in ids and p[k:] in ids
    }
    keys = np.array(sorted(pairs), np.int64)
    places = np.array([pairs[k] for k in keys.tolist()], np.int64)
    char = np.full(0x110000, -1, np.int32)
    for p, i in ids.items():
        if len(p) == 1:
            char[ord(p)] = i
    return Vocabulary(ids, pairs, merged, *_table(keys, places), np.array(merged, np.int64), char, byte, b"".join(surface), place)


#: Symbols of this number on are characters that are no piece.
STRANGE = 1 << 24


class Chunks:
    """Distinct chunks by a 64-bit hash of their bytes: ids without dropout, and the agenda entries that
    were merged on the way, each chunk's in one run of one array."""

    def __init__(self, learn):
        self.learn = learn
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.spans = np.zeros((0, 4), np.int64)  # first id, ids, first entry, entries
        self.ids, self.entries = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def slots(self, h: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of each chunk (by its hash) in the memo, which learns what it lacks."""
        if len(self.keys) > MEMO:
            self.clear()
        slot = np.minimum(np.searchsorted(self.keys, h), max(0, len(self.keys) - 1))
        lack = np.flatnonzero(self.keys[slot] != h) if len(self.keys) else np.arange(len(h))
        if not len(lack):
            return slot
        new, first = np.unique(h[lack], return_index=True)
        rows = lack[first]
        ids, n, entries, m = self.learn([raw[s:e] for s, e in zip(start[rows].tolist(), end[rows].tolist())])
        spans = np.stack([len(self.ids) + np.cumsum(n) - n, n, len(self.entries) + np.cumsum(m) - m, m], axis=1)
        self.ids, self.entries = np.concatenate([self.ids, ids]), np.concatenate([self.entries, entries])
        keys = np.concatenate([self.keys, new])
        order = np.argsort(keys, kind="stable")
        self.keys, self.spans = keys[order], np.concatenate([self.spans, spans])[order]
        return np.searchsorted(self.keys, h)


class Encoder:
    def __init__(self, vocabulary: Vocabulary, params: Params = Params()):
        self.v, self.p = vocabulary, params
        self.limit = int(params.dropout * (1 << 32))
        self.chunks = Chunks(self._learn)

    # --- merging ----------------------------------------------------------------------

    def _skips(self, key: np.ndarray, entry: np.ndarray) -> np.ndarray:
        h = (key ^ entry.view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = ((h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)
        return h < np.uint64(self.limit)

    def symbols(self, data: np.ndarray):
        """Symbol of every character of a run of bytes (spaces are U+2581; a literal U+2581, like all
        that is no piece, is STRANGE), and the byte at which each begins."""
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        sym = self.v.char[np.where(code == 32, ord(SPACE), code)].astype(np.int64)
        odd = np.flatnonzero((sym < 0) | (code == ord(SPACE)))
        sym[odd] = STRANGE + code[odd]
        at = np.arange(len(code)) if len(code) == len(data) else np.flatnonzero((data & 0xC0) != 0x80)
        return sym, at

    def merge(self, sym: list[int], key: int | None) -> tuple[list[int], list[int]]:
        """Symbols of one chunk after its agenda, and the entries merged; an entry is the place in the
        order of scores << 32 | place of the left symbol.  Without a key nothing is skipped."""
        merged, pair = self.v.merged, self.v.pairs.get
        sym = list(sym)
        n = len(sym)
        agenda, took = [], []
        for i in range(1, n):
            at = pair(sym[i - 1] << 32 | sym[i])
            if at is not None:
                agenda.append(at << 32 | i - 1)
        heapify(agenda)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            entry = heappop(agenda)
            i, at = entry & 0xFFFFFFFF, entry >> 32
            j = nxt[i]
            if sym[i] < 0 or j >= n or pair(sym[i] << 32 | sym[j]) != at:
                continue  # one of the two is part of another merge by now
            if key is not None:
                h = ((key ^ entry) * 0xBF58476D1CE4E5B9) & _M
                if (((h ^ (h >> 29)) * 0x94D049BB133111EB) & _M) >> 32 < self.limit:
                    continue
            took.append(entry)
            left = sym[i] = merged[at]
            sym[j] = -2
            j = nxt[i] = nxt[j]
            if j < n:
                prev[j] = i
                at = pair(left << 32 | sym[j])
                if at is not None:
                    heappush(agenda, at << 32 | i)
            h = prev[i]
            if h >= 0:
                at = pair(sym[h] << 32 | left)
                if at is not None:
                    heappush(agenda, at << 32 | h)
        return [s for s in sym if s >= 0], took

    def merge_many(self, sym: np.ndarray, first: np.ndarray, size: np.ndarray, keys: np.ndarray | None):
        """``merge`` of many chunks (runs of ``sym``) at once: (symbols, their number for each chunk, entries, their
        number; entries without keys only): a row of arrays for each chunk, in which every round processes
        the row's next agenda entry (the smallest place in the order of scores, leftmost of equals)."""
        n, m = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        made = []  # (chunks, symbols, entries), each chunk's in a row
        order = np.argsort(size, kind="stable")
        wide = int(np.searchsorted(size[order], WIDE, side="right"))
        for i in order[wide:].tolist():  # long ones one by one
            got, entries = self.merge(sym[first[i] : first[i] + size[i]].tolist(), None if keys is None else int(keys[i]))
            n[i], m[i] = len(got), len(entries)
            made.append((np.array([i]), np.array(got, np.int64), np.array(entries, np.int64)))
        for at in range(0, wide, 2048):
            rows = order[at : min(wide, at + 2048)]
            inside = np.arange(size[rows[-1]]) < size[rows][:, None]
            block = np.full(inside.shape, -2, np.int32)
            block[inside] = sym[runs(first[rows], size[rows])]
            symbols, n[rows], entries, m[rows] = self._rounds(block, None if keys is None else keys[rows])
            made.append((rows, symbols, entries))
        out, took = np.empty(int(n.sum()), np.int64), np.empty(int(m.sum()), np.int64)
        at_n, at_m = np.cumsum(n) - n, np.cumsum(m) - m
        for rows, symbols, entries in made:
            out[runs(at_n[rows], n[rows])] = symbols
            took[runs(at_m[rows], m[rows])] = entries
        return out, n, took, m

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair's merge in the order of scores, or NONE."""
        want = left.astype(np.int64) << 32 | right
        table, places = self.v.pair_keys, self.v.pair_places
        slot = _slot(want, len(table))
        got = table[slot]
        out = np.where(got == want, places[slot], NONE).astype(np.int32)
        again = np.nonzero((got != want) & (got >= 0))
        while len(again[0]):  # another pair's slot: the next one
            slot[again] = (slot[again] + 1) & (len(table) - 1)
            got = table[slot[again]]
            out[again] = np.where(got == want[again], places[slot[again]], NONE)
            go = (got != want[again]) & (got >= 0)
            again = tuple(x[go] for x in again)
        return out

    def _rounds(self, sym: np.ndarray, key: np.ndarray | None):
        n, width = sym.shape
        row = np.arange(n)
        last = np.full((n, width), -2, np.int32)
        # a column of no symbol at both ends; the others know their neighbours' columns
        wide = width + 2
        sym = np.pad(sym, ((0, 0), (1, 1)), constant_values=-2)
        rank = np.full((n, wide), NONE, np.int32)
        rank[:, :-1] = self._pair(sym[:, :-1], sym[:, 1:])
        column = np.arange(wide, dtype=np.int32)
        nxt, prev = np.tile(column + 1, (n, 1)), np.tile(column - 1, (n, 1))
        rows_took, took = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(row):
            b = rank.argmin(axis=1)
            base = np.arange(len(row)) * wide
            f = base + b
            at = rank.ravel()[f]
            over = at == NONE
            done = np.count_nonzero(over)
            if done * 8 > len(row) or done == len(row):  # finished rows go when they are many
                last[row[over]] = sym[over, 1:-1]
                go = np.flatnonzero(~over)
                row, sym, rank, nxt, prev, b, at = (x[go] for x in (row, sym, rank, nxt, prev, b, at))
                if key is not None:
                    key = key[go]
                if not len(row):
                    break
                base = base[: len(row)]
                f = base + b
                over = None
            elif not done:
                over = None
            entry = at.astype(np.int64) << 32 | (b - 1)
            stay = over
            if key is not None:
                skip = self._skips(key, entry)
                rank.ravel()[f[skip]] = NONE
                stay = skip if over is None else skip | over
            if stay is not None:
                m = np.flatnonzero(~stay)
                if not len(m):
                    continue
                b, base, f, at, entry = b[m], base[m], f[m], at[m], entry[m]
            if key is None:
                rows_took.append(row if stay is None else row[m])
                took.append(entry)
            # the right symbol goes into the left one, whose neighbours are paired with it anew
            s, q, ahead, back = (x.ravel() for x in (sym, rank, nxt, prev))
            gone = base + ahead[f]
            after = ahead[gone]
            right, left = base + after, base + back[f]
            made = self.v.merged_array[at]
            s[f], s[gone], q[gone], ahead[f], back[right] = made, -2, NONE, after, b
            q[np.concatenate([f, left])] = self._pair(np.concatenate([made, s[left]]), np.concatenate([s[right], made]))
        who = np.concatenate(rows_took)
        entries = np.concatenate(took)[np.argsort(who, kind="stable")]
        return last[last >= 0], (last >= 0).sum(axis=1), entries, np.bincount(who, minlength=n)

    def _learn(self, chunks: list[bytes]):
        data = np.frombuffer(b"".join(chunks), np.uint8)
        stop = np.cumsum([len(c) for c in chunks])
        sym, at = self.symbols(data)
        end = np.searchsorted(at, stop)
        first = np.concatenate([[0], end[:-1]])
        return self.merge_many(sym, first, end - first, None)

    # --- texts --------------------------------------------------------------------------

    @staticmethod
    def starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where the chunks of a run of documents begin: at runs of spaces, and at both ends of a literal U+2581."""
        space = data == 32
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[off[:-1][off[:-1] < len(data)]] = True
        if len(data) > 2:
            a, b, c = _LITERAL
            at = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))
            head[at] = True
            head[at[at + 3 < len(data)] + 3] = True
        return np.flatnonzero(head)

    def encode_run(self, data: np.ndarray, off: np.ndarray, keys: np.ndarray):
        """Ids of a run of documents, which begin with a space, and each one's bounds."""
        start = self.starts(data, off)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        end = np.append(start[1:], len(data))
        raw = data.tobytes()
        slot = self.chunks.slots(RollingHash(data).of(start, end), raw, start, end)
        span = self.chunks.spans[slot]
        at, n, ids = span[:, 0].copy(), span[:, 1].copy(), self.chunks.ids
        if self.limit:
            doc = np.searchsorted(off, start, side="right") - 1
            key = mix64(keys[doc] * np.uint64(0xD1B54A32D192ED03) + np.uint64(self.p.seed * 0x9E3779B97F4A7C15 & _M))
            key = mix64(key ^ (start - off[doc]).astype(np.uint64))
            m = span[:, 3]
            who = np.repeat(np.arange(len(start)), m)
            drawn = self._skips(key[who], self.chunks.entries[runs(span[:, 2], m)])
            rows = np.unique(who[drawn])
            sym, char = self.symbols(data)
            first, stop = np.searchsorted(char, start[rows]), np.searchsorted(char, end[rows])
            got, count, _, _ = self.merge_many(sym, first, stop - first, key[rows])
            at[rows], n[rows] = len(ids) + np.cumsum(count) - count, count
            ids = np.concatenate([ids, got])
        ids = ids[runs(at, n)]
        stop = np.concatenate([[0], np.cumsum(n)])
        bounds = stop[np.searchsorted(start, off)]
        odd = np.flatnonzero(ids >= STRANGE)
        if len(odd):  # characters that are no piece become their bytes
            parts = [[self.v.byte[b] for b in chr(c - STRANGE).encode()] for c in ids[odd].tolist()]
            more = np.array([len(p) for p in parts]) - 1
            cut = np.split(ids, odd)
            whole = [cut[0]]
            for p, c in zip(parts, cut[1:]):
                whole += [np.array(p, np.int64), c[1:]]
            ids = np.concatenate(whole)
            bounds = bounds + np.concatenate([[0], np.cumsum(more)])[np.searchsorted(odd, bounds)]
        return ids.astype(np.int32), bounds

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        data = np.frombuffer((" " + text).encode(), np.uint8) if text else np.zeros(0, np.uint8)
        return self.encode_run(data, np.array([0, len(data)]), np.array([key & _M], np.uint64))[0]


def surfaces(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The ids' surfaces, joined: each id's run of bytes is looked up in one array."""
    n = vocabulary.place[ids + 1] - vocabulary.place[ids]
    at = np.repeat(vocabulary.place[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.frombuffer(vocabulary.surface, np.uint8)[at].tobytes()


def decode(vocabulary: Vocabulary, ids) -> str:
    """The text of a list of ids: inverse of Encoder.encode for every text."""
    return surfaces(vocabulary, np.asarray(ids, np.int64))[1:].decode("utf-8")


def _encode_arrow(shared, params: Params, with_ids: bool):
    def run(batches):
        vocabulary = shared.value
        encoder = Encoder(vocabulary, params)
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, j, data, off in text_slices(batch.column(2), SLAB):
                ids, bounds = encoder.encode_run(data, off, keys[i:j])
                same = _same(vocabulary, ids, bounds, data, off)
                for d in np.flatnonzero(~same).tolist():  # two chunks of one hash: encoded without the memo
                    alone = Encoder(vocabulary, params)
                    got = alone.encode_run(data[off[d] : off[d + 1]], np.array([0, off[d + 1] - off[d]]), keys[i + d : i + d + 1])[0]
                    ids = np.concatenate([ids[: bounds[d]], got, ids[bounds[d + 1] :]])
                    bounds = np.concatenate([bounds[: d + 1], bounds[d + 1 :] + len(got) - (bounds[d + 1] - bounds[d])])
                    same[d] = surfaces(vocabulary, got.astype(np.int64)) == data[off[d] : off[d + 1]].tobytes()
                cols = [batch.column(0).slice(i, j - i), pa.array(np.diff(bounds)), pa.array(same)]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "lossless", "ids"][: len(cols)])

    return run


def _same(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each document's ids decode to its bytes."""
    got = np.frombuffer(surfaces(vocabulary, ids.astype(np.int64)), np.uint8)
    if np.array_equal(got, data):
        return np.ones(len(off) - 1, bool)
    size = vocabulary.place[ids.astype(np.int64) + 1] - vocabulary.place[ids.astype(np.int64)]
    stop = np.concatenate([[0], np.cumsum(size)])[bounds]
    return np.array([np.array_equal(got[a:b], data[c:d]) for a, b, c, d in zip(stop, stop[1:], off, off[1:])])


def tokenize(docs: DataFrame, model: str = MODEL, params: Params = Params(), with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, lossless (the ids were decoded and gave the text) and ids for every
    row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, lossless boolean" + ", ids array<int>" * with_ids
    text = F.when(F.length("text") > 0, F.concat(F.lit(" "), "text")).otherwise(F.lit(""))
    src = docs.select("doc_id", F.coalesce(row_key(docs), F.lit(0)).alias("key"), text.alias("text"))
    return src.mapInArrow(tidy(_encode_arrow(shared, params, with_ids)), schema)

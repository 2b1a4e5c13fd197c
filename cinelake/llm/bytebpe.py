"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokenisation.  The pattern of the public byte-level tokenizers (contractions, words,
numbers, marks, each with one space in front, and runs of white space) is a small automaton
over codepoint classes; no regular expression touches a text.  A character's class, and what
it can see of the next two, give one of ``2 * len(KINDS)`` symbols.  Each symbol is a function from
states to states; all functions that compositions of these can give are numbered once
(``MONOID``), so the state before every character comes from an associative scan: blocks
compose their functions side by side, the block totals are scanned the same way, and one look-up
applies them.  State and symbol say whether a slice begins there.

Merging.  Slices of all documents of a run are looked up at once, by a 64-bit hash, in a
bounded memo; what it lacks is merged for all slices together, a round of arrays at a time:
in each slice the neighbouring pair whose join has the lowest rank, leftmost of equals; a slice that is an
entry itself is that entry.  Ids come with the byte offset at which each token ends.

Decoding joins the entries' bytes.  Every run is decoded and compared with its input, so a
hash collision in the memo cannot pass: such documents are encoded again without hashes.

Defined cases: null and empty texts give no ids; texts are encoded whole, whatever their length;
repeated rows get the same ids; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import json
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.common import RollingHash, text_slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Bytes of text encoded at a time.
RUN = 1 << 20
#: Slices a memo holds before it starts anew.
MEMO = 1 << 19
#: Bytes of a slice in the array form of merging.
WIDE = 40
#: Characters that one step of the scan's blocks goes over.
_BLOCK = 256

# --- the automaton ------------------------------------------------------------------------

#: Codepoint classes.
LETTER, NUMBER, OTHER, WHITE = range(4)
#: Symbols: letter, number, other mark, apostrophe that one or two letters of a contraction
#: follow, white space with more of it (or the end) behind, last space of a run, other last
#: white space of a run.
KINDS = ("letter", "number", "mark", "short", "long", "white", "space", "gap")
#: States, by what the last character was part of; ``done`` ended its slice.
STATES = ("letters", "numbers", "marks", "joining", "whites", "two", "one", "done")


def _step(state: str, kind: str) -> tuple[str, bool]:
    """Next state, and whether a slice begins with the character."""
    if kind == "letter":
        if state in ("two", "one"):
            return ("one" if state == "two" else "done"), False
        return "letters", state not in ("letters", "joining")
    if kind == "number":
        return "numbers", state not in ("numbers", "joining")
    if kind in ("mark", "short", "long"):
        goes_on = state in ("marks", "joining")
        if kind == "mark" or goes_on:
            return "marks", not goes_on
        return ("one" if kind == "short" else "two"), True
    if kind == "white":
        return "whites", state != "whites"
    return ("joining" if kind == "space" else "done"), True


def _monoid():
    """All functions of states that sequences of symbols compose to: their number for each
    symbol (a document's first character ignores the state before it), the table of
    compositions, and the functions themselves."""
    steps = [tuple(STATES.index(_step(s, k)[0]) for s in STATES) for k in KINDS]
    steps += [(STATES.index(_step("done", k)[0]),) * len(STATES) for k in KINDS]
    identity = tuple(range(len(STATES)))
    number = {identity: 0}
    queue = [identity]
    for f in queue:
        for g in steps:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(queue)
                queue.append(h)
    n = len(queue)
    table = np.array([[number[tuple(g[s] for s in f)] for g in queue] for f in queue], np.uint8 if n <= 256 else np.uint16)
    return np.array([number[g] for g in steps], table.dtype), table, np.array(queue, np.uint8)


SYMBOL, MONOID, APPLY = _monoid()
BEGINS = np.array([[_step(s, k)[1] for k in KINDS] for s in STATES])


def scan(f: np.ndarray) -> np.ndarray:
    """For a sequence of function numbers, those of all its prefixes' compositions."""
    n = len(f)
    if n <= 1:
        return f.copy()
    width = min(_BLOCK, max(2, int(n**0.5)))
    rows = -(-n // width)
    padded = np.zeros(rows * width, f.dtype)  # 0: the identity
    padded[:n] = f
    acc = np.ascontiguousarray(padded.reshape(rows, width).T)
    size = MONOID.shape[0]
    flat = MONOID.ravel()
    for j in range(1, width):
        acc[j] = flat[acc[j - 1].astype(np.int32) * size + acc[j]]
    if rows > 1:
        before = np.zeros(rows, f.dtype)
        before[1:] = scan(acc[-1].copy())[:-1]
        acc = flat[before.astype(np.int32) * size + acc]
    return acc.T.reshape(-1)[:n]


def codepoint_classes() -> np.ndarray:
    """Class of every codepoint, as the installed library's engine has them: one pass over all
    codepoints at load time, so that tables of another Unicode version can't differ."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        probe = tiktoken.Encoding(f"class-{kind}", pat_str=name, mergeable_ranks=single, special_tokens={})
        held = probe.decode_bytes(probe.encode_ordinary(every)).decode()
        out[np.frombuffer(held.encode("utf-32-le"), np.uint32)] = kind
    return out


def slice_starts(data: np.ndarray, off: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte offsets at which the slices of a run of documents begin (``off``: document bounds)."""
    if not len(data):
        return np.zeros(0, np.int64)
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    plain = len(code) == len(data)
    at = None if plain else np.flatnonzero((data & 0xC0) != 0x80)
    live = np.flatnonzero(off[1:] > off[:-1])
    heads, ends = off[live], off[live + 1]
    if not plain:
        heads = np.searchsorted(at, heads)
        ends = np.append(heads[1:], len(code))
    kind = classes[code]
    last = ends - 1
    after = np.empty_like(kind)
    after[:-1] = kind[1:]
    after[last] = WHITE  # white space at the end goes on to the end
    white = kind == WHITE
    symbol = kind.astype(np.uint8)
    symbol[white] = np.where(after[white] == WHITE, 5, np.where(code[white] == 32, 6, 7))
    quote = np.flatnonzero(code == 39)
    if len(quote):
        one = np.zeros(len(code) + 2, np.uint32)
        one[: len(code) - 1] = code[1:]
        one[last] = 0
        a, b = one[quote], one[quote + 1]
        b = np.where(a > 0, b, 0)
        s, t, m, d, r, e, v, el = (ord(c) for c in "stmdrevl")
        short = (a == s) | (a == t) | (a == m) | (a == d)
        long = ((a == r) & (b == e)) | ((a == v) & (b == e)) | ((a == el) & (b == el))
        symbol[quote[short]] = 3
        symbol[quote[long]] = 4
    f = SYMBOL[symbol]
    f[heads] = SYMBOL[symbol[heads] + len(KINDS)]
    state = APPLY[scan(f), 0]
    begins = np.empty(len(code), bool)
    begins[1:] = BEGINS[state[:-1], symbol[1:]]
    begins[heads] = True
    start = np.flatnonzero(begins)
    return start if plain else at[start]


# --- merging --------------------------------------------------------------------------------


@dataclass
class Vocabulary:
    whole: dict[bytes, int]  # slices that are an entry without merging
    byte: np.ndarray  # id of each byte
    pairs: np.ndarray  # left id << 32 | right id of all pairs that join to an entry, sorted
    joined: np.ndarray  # that entry
    surface: np.ndarray  # bytes of all entries, one after the other
    place: np.ndarray  # where each id's bytes begin
    classes: np.ndarray
    memo: "Memo | None" = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "memo": None}


def vocabulary(ranks: dict[bytes, int], classes: np.ndarray, merges: list[tuple[bytes, bytes]] | None = None) -> Vocabulary:
    """Entries by rank.  Without a list of merges any two entries join that give an entry, and a slice
    that is one needs no merging; with one (best first, ranks in the same order) only its pairs join."""
    if merges is None:
        halves = ((b[:k], b[k:]) for b in ranks for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks)
    else:
        halves = iter(merges)
        order = [ranks[a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError("entries are not numbered in the order of their merges")
    pairs = sorted((ranks[a] << 32 | ranks[b], ranks[a + b]) for a, b in halves)
    n = max(ranks.values(), default=-1) + 1
    surface = [b""] * n
    for b, r in ranks.items():
        surface[r] = b
    place = np.zeros(n + 1, np.int64)
    np.cumsum([len(b) for b in surface], out=place[1:])
    byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    keys = np.array([p[0] for p in pairs], np.int64)
    whole = ranks if merges is None else {}
    return Vocabulary(whole, byte, keys, np.array([p[1] for p in pairs], np.int64), np.frombuffer(b"".join(surface), np.uint8), place, classes)


def load(path: str = RANKS) -> Vocabulary:
    """Entries of a rank file (read on the driver and sent to the tasks)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return vocabulary(ranks, codepoint_classes())


def load_json(path: str) -> Vocabulary:
    """Entries and merges of a tokenizer file that writes bytes as printable characters."""
    with open(path, encoding="utf-8") as text:
        model = json.load(text)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown}
    byte.update((chr(256 + n), b) for n, b in enumerate(b for b in range(256) if b not in shown))
    raw = {e: bytes(byte[c] for c in e) for e in model["vocab"] if all(c in byte for c in e)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = {a + b for a, b in merges}  # special tokens are no entries: nothing merges to them
    ranks = {raw[e]: i for e, i in model["vocab"].items() if e in raw and (len(e) == 1 or e in made)}
    return vocabulary(ranks, codepoint_classes(), [(raw[a], raw[b]) for a, b in merges])


_NONE = np.int64(1 << 40)


def _ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair's join, or _NONE."""
    want = left << 32 | right
    at = np.minimum(np.searchsorted(v.pairs, want), len(v.pairs) - 1)
    return np.where(v.pairs[at] == want, v.joined[at], _NONE)


def merge_one(v: Vocabulary, raw: bytes) -> list[int]:
    """Ids of one slice, of any length: an agenda of pairs by rank, then place."""
    if raw in v.whole:
        return [v.whole[raw]]
    sym = v.byte[np.frombuffer(raw, np.uint8)]
    n = len(sym)
    rank = _ranks(v, sym[:-1], sym[1:]).tolist()
    sym = sym.tolist()
    nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    table = {}

    def join(a: int, b: int) -> int:
        key = a << 32 | b
        if key not in table:
            table[key] = int(_ranks(v, np.array([a]), np.array([b]))[0])
        return table[key]

    agenda = [(r, i) for i, r in enumerate(rank) if r < _NONE]
    heapify(agenda)
    while agenda:
        r, i = heappop(agenda)
        j = nxt[i]
        if sym[i] < 0 or j >= n or join(sym[i], sym[j]) != r:
            continue
        sym[i], sym[j] = r, -1
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if (more := join(r, sym[nxt[i]])) < _NONE:
                heappush(agenda, (more, i))
        if prev[i] >= 0 and (more := join(sym[prev[i]], r)) < _NONE:
            heappush(agenda, (more, prev[i]))
    return [s for s in sym if s >= 0]


def _merge_rows(v: Vocabulary, sym: np.ndarray) -> np.ndarray:
    """Merge the rows of a matrix of ids (-1 behind the end), one pair a row and round."""
    out = np.full_like(sym, -1)
    row = np.arange(len(sym))
    n, width = sym.shape
    rank = np.full((n, width), _NONE)
    rank[:, :-1] = _ranks(v, sym[:, :-1], sym[:, 1:])
    cols = np.arange(width)
    while len(row):
        b = rank.argmin(axis=1)
        line = np.arange(len(row))
        best = rank[line, b]
        over = best == _NONE
        if over.any():
            out[row[over], : sym.shape[1]] = sym[over]
            go = ~over
            row, sym, rank, b, best = row[go], sym[go], rank[go], b[go], best[go]
            if not len(row):
                break
            used = int((sym >= 0).sum(axis=1).max())
            sym, rank, cols = sym[:, :used], rank[:, :used], cols[:used]
            line = np.arange(len(row))
        width = sym.shape[1]
        src = np.minimum(cols + (cols > b[:, None]), width - 1)
        sym = np.take_along_axis(sym, src, axis=1)
        rank = np.take_along_axis(rank, src, axis=1)
        sym[:, -1], rank[:, -1] = -1, _NONE
        sym[line, b] = best
        behind = np.where(b + 1 < width, sym[line, np.minimum(b + 1, width - 1)], -1)
        rank[line, b] = _ranks(v, best, behind)
        has = b > 0
        rank[line[has], b[has] - 1] = _ranks(v, sym[line[has], b[has] - 1], best[has])
    return out


def merge_many(v: Vocabulary, slices: list[bytes]) -> list[np.ndarray]:
    """Ids of each slice."""
    out: list = [None] * len(slices)
    todo = []
    for i, raw in enumerate(slices):
        whole = v.whole.get(raw)
        if whole is not None:
            out[i] = np.array([whole], np.int32)
        elif len(raw) > WIDE:
            out[i] = np.array(merge_one(v, raw), np.int32)
        else:
            todo.append(i)
    todo.sort(key=lambda i: len(slices[i]))
    for k in range(0, len(todo), 4096):
        part = todo[k : k + 4096]
        size = np.array([len(slices[i]) for i in part])
        inside = np.arange(size[-1]) < size[:, None]
        sym = np.full(inside.shape, -1, np.int64)
        sym[inside] = v.byte[np.frombuffer(b"".join([slices[i] for i in part]), np.uint8)]
        done = _merge_rows(v, sym)
        stop = np.cumsum((done >= 0).sum(axis=1)).tolist()
        flat = done[done >= 0].astype(np.int32)
        for i, a, b in zip(part, [0, *stop], stop):
            out[i] = flat[a:b]
    return out


class Memo:
    """Ids of slices by a 64-bit hash of their bytes, for whole arrays of slices: sorted keys,
    and each key's run in one array of ids.  ``learn`` gives the ids of a list of byte strings."""

    def __init__(self, learn, limit: int = MEMO):
        self.learn, self.limit = learn, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(1, np.int64)[:0]
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(ids of all slices, one after the other; number of ids of each slice)."""
        h = RollingHash(data).of(start, end)
        if len(self.keys) > self.limit:
            self.clear()
        slot = np.minimum(np.searchsorted(self.keys, h), max(0, len(self.keys) - 1))
        lack = self.keys[slot] != h if len(self.keys) else np.ones(len(h), bool)
        if lack.any():
            rows = np.flatnonzero(lack)
            new, first = np.unique(h[rows], return_index=True)
            rows = rows[first]
            raw = data.tobytes()
            got = self.learn([raw[s:e] for s, e in zip(start[rows].tolist(), end[rows].tolist())])
            n = np.array([len(g) for g in got], np.int64)
            at = len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, *got])
            keys = np.concatenate([self.keys, new])
            order = np.argsort(keys, kind="stable")
            self.keys, self.at, self.n = keys[order], np.concatenate([self.at, at])[order], np.concatenate([self.n, n])[order]
            slot = np.searchsorted(self.keys, h)
        n = self.n[slot]
        return self.ids[runs(self.at[slot], n)], n


def runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] of them), start[1], ..."""
    stop = np.cumsum(n)
    return np.repeat(start - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)


def surfaces(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Bytes of the ids' entries, joined."""
    return v.surface[runs(v.place[ids], v.place[ids + 1] - v.place[ids])]


def decode(v: Vocabulary, ids) -> bytes:
    return surfaces(v, np.asarray(ids, np.int64)).tobytes()


def encode_run(v: Vocabulary, data: np.ndarray, off: np.ndarray):
    """Ids of a run of documents and the bounds of each document in them."""
    if v.memo is None:
        v.memo = Memo(lambda slices: merge_many(v, slices))
    start = slice_starts(data, off, v.classes)
    end = np.append(start[1:], len(data))
    ids, n = v.memo.lookup(data, start, end) if len(start) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    stop = np.concatenate([[0], np.cumsum(n)])
    bounds = stop[np.searchsorted(start, off)]
    if not np.array_equal(surfaces(v, ids), data):  # two slices of one hash: by their bytes
        cut = np.split(start, np.searchsorted(start, off[1:-1]))
        raw = data.tobytes()
        parts = [[x for s, e in zip(c, [*c[1:], o]) for x in merge_many(v, [raw[s:e]])[0]] for c, o in zip(cut, off[1:])]
        ids = np.array([x for p in parts for x in p], np.int32)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return ids, bounds


def token_ends(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Byte offset behind each token of a run."""
    return np.cumsum(v.place[ids + 1] - v.place[ids])


# --- Spark ----------------------------------------------------------------------------------


def _encode_arrow(shared):
    def run(batches):
        v = shared.value
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(1), RUN):
                ids, bounds = encode_run(v, data, off)
                ends = token_ends(v, ids) - np.repeat(off[:-1], np.diff(bounds))
                cut = pa.array(bounds.astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (ids, ends)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *lists], ["row", "ids", "ends"])

    return run


def encode(docs: DataFrame, path: str = RANKS, text: str = "text") -> DataFrame:
    """All rows of ``docs`` without the text, and of the whole text the token ``ids`` and the
    byte offset at which each token ``ends``.  Columns of those names make way."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    others = [c for c in docs.columns if c not in (text, "ids", "ends")]
    src = docs.select(F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text}`"))
    schema = T.StructType([src.schema["row"], *T._parse_datatype_string("ids array<int>, ends array<int>").fields])
    return src.mapInArrow(_encode_arrow(shared), schema).select(*[F.col("row").getField(c).alias(c) for c in others], "ids", "ends")


def _decode_arrow(shared):
    def run(batches):
        v = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column(1)[r].values
                raw = decode(v, ids.to_numpy()) if ids is not None and len(ids) else b""
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(r, 1), pa.array([raw], pa.binary())], ["row", "bytes"])

    return run


def decoded(tokens: DataFrame, path: str = RANKS) -> DataFrame:
    """Inverse of ``encode``: all rows with the bytes of their ``ids`` in ``bytes``."""
    shared = tokens.sparkSession.sparkContext.broadcast(load(path))
    others = [c for c in tokens.columns if c not in ("ids", "bytes")]
    src = tokens.select(F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in others]).alias("row"), "ids")
    schema = T.StructType([src.schema["row"], T.StructField("bytes", T.BinaryType())])
    return src.mapInArrow(_decode_arrow(shared), schema).select(*[F.col("row").getField(c).alias(c) for c in others], "bytes")


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_arrow(shared):
    def run(batches):
        v = shared.value
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(1), RUN):
                ids, bounds = encode_run(v, data, off)
                out = surfaces(v, ids)
                stop = np.concatenate([[0], token_ends(v, ids)])[bounds]
                little = ids.astype("<u4").tobytes()
                sha = hashlib.sha256
                b, s, raw = bounds.tolist(), stop.tolist(), out.tobytes()
                cols = [
                    pa.array(np.diff(bounds)),
                    pa.array([sha(little[4 * x : 4 * y]).hexdigest() for x, y in zip(b, b[1:])], pa.string()),
                    pa.array([sha(raw[x:y]).hexdigest() for x, y in zip(s, s[1:])], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *cols], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def digests(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_digest_arrow(shared), f"doc_id {kind}, {DIGEST}")

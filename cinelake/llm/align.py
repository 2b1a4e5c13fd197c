"""Cross-tokenizer alignment by diagonal run skipping.

Both tokenizers cut the same bytes (a space and the text).  Bytes at which a token of each ends cut
the two sequences into groups.  Where tokens correspond one to one, the end arrays are equal at a
constant shift of their indices, so a probe compares ever longer stretches at the current shift (1, 2,
4, ... ends) and jumps what is equal.  At the first difference an irregular group is resolved
locally: the side that lags takes its next token until both end at the same byte, which also
gives the new shift.  Lanes that start at common ends run in lockstep over a slab of documents.

Counts.  Each slab keeps, in a written table, the distinct (A id, B id) pairs of its links, how many of
its documents hold each, and each document's pairs and weights, in the narrowest integers that hold them.  A slab is
worked on in parts, of which only that is kept, and goes on over the ends of Arrow batches.  Pairs are summed over all slabs; what a
slab needs of the sums comes back to it by a join on the pair, a row for each distinct
pair of a slab, and meets the slab in one shuffle.  Neither the pairs of the corpus nor the links of a
document are ever collected.

Defined cases: null and empty texts, and texts whose joined token bytes differ from space+text (a literal
U+2581), have no tokens and count zero; every row is a document, so repeated rows
count as often as they stand there; strings of special tokens are ordinary text; a group's links are all
its pairs, of any number.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm import bytebpe
from cinelake.llm.bytebpe import Memo, Vocabulary, runs
from cinelake.llm.common import small_batches, text_slices, tidy
from cinelake.session import materialize

BYTES_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text in a slab.
SLAB = 1 << 21
#: Bytes of text tokenized and aligned at a time; temporaries are some 70 times that.
PART = 1 << 19
#: Bytes of a batch for a Python task, and of a row group of slabs.
BATCH = 1 << 22
#: Documents of a slab, however short.
ROWS = 1 << 14
#: Tokens of a lane.
LANE = 64
#: Links of a group above which its distinct ids are paired instead of its tokens.
LARGE = 1 << 10


# --- the two tokenizers -----------------------------------------------------------------------


class Pieces:
    """The merge type of a piece model, read on the driver and sent to the tasks."""

    def __init__(self, model: bytes):
        self.model = model
        self._ready = None

    def __getstate__(self):
        return {"model": self.model, "_ready": None}

    def ready(self):
        """(processor, bytes of all pieces, where each begins, memo of chunks)."""
        if self._ready is None:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
            surface = []
            for i in range(sp.get_piece_size()):
                piece = sp.id_to_piece(i)
                if sp.is_byte(i):
                    surface.append(bytes([int(piece[3:5], 16)]))
                else:
                    surface.append(b"" if sp.is_control(i) else piece.replace("▁", " ").encode())
                if "▁" in piece.lstrip("▁"):
                    raise ValueError(f"piece {piece} reaches over the start of a chunk")
            place = np.zeros(len(surface) + 1, np.int64)
            np.cumsum([len(s) for s in surface], out=place[1:])
            space = sp.piece_to_id("▁")

            def learn(chunks: list[bytes]) -> list[np.ndarray]:
                # the processor adds the first space itself, but for an empty text
                got = sp.encode([c[1:].decode() for c in chunks], num_threads=1)
                return [np.array(g if c != b" " else [space], np.int32) for c, g in zip(chunks, got)]

            self._ready = sp, np.frombuffer(b"".join(surface), np.uint8), place, Memo(learn)
        return self._ready

    def encode(self, data: np.ndarray, off: np.ndarray):
        """Ids of a run of documents that begin with a space, and each one's bounds."""
        _, _, _, memo = self.ready()
        space = data == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[off[:-1][off[:-1] < len(data)]] = True
        start = np.flatnonzero(start)
        ids, n = memo.lookup(data, start, np.append(start[1:], len(data))) if len(start) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        return ids, np.concatenate([[0], np.cumsum(n)])[np.searchsorted(start, off)]


class Pair:
    """Two tokenizers: A, byte-level merges; B, pieces."""

    def __init__(self, a: Vocabulary, b: Pieces):
        self.a, self.b = a, b
        self._text: list[bytes] = []

    def __getstate__(self):
        return {"a": self.a, "b": self.b, "_text": []}

    def decimals(self, size: int) -> list[bytes]:
        """Each id as decimal digits and the signs that can follow it: within A's part of a group, at its
        end, and the same for B's (three places a side)."""
        for i in range(len(self._text) // 6, size):
            digits = str(i).encode()
            self._text += [digits + s for s in (b",", b"|", b"", b",", b";", b"")]
        return self._text

    def encode(self, data: np.ndarray, off: np.ndarray):
        """(ids, bounds, token ends) of A and of B over a slab; documents whose bytes either does not
        give back have none, and the ends are as if those were empty."""
        a, at = bytebpe.encode_run(self.a, data, off)
        b, bt = self.b.encode(data, off)
        sp, surface, place, _ = self.b.ready()
        size = place[b + 1] - place[b]
        if not (size.sum() == len(data) and np.array_equal(surface[runs(place[b], size)], data)):
            a, at, b, bt = self._repair(data, off, a, at, b, bt, sp, surface, place)
            size = place[b + 1] - place[b]
        return (a, at, bytebpe.token_ends(self.a, a)), (b, bt, np.cumsum(size))

    @staticmethod
    def _repair(data, off, a, at, b, bt, sp, surface, place):
        """One by one, what differs goes through the library whole, and has no tokens if it still differs."""
        pa_, pb = [], []
        for i in range(len(off) - 1):
            raw = data[off[i] : off[i + 1]].tobytes()
            mine, other = a[at[i] : at[i + 1]], b[bt[i] : bt[i + 1]]

            def joined(ids):
                return surface[runs(place[ids], place[ids + 1] - place[ids])].tobytes()

            if joined(other) != raw:
                other = np.array(sp.encode(raw[1:].decode()), np.int32)
                if joined(other) != raw:
                    mine, other = mine[:0], other[:0]
            pa_.append(mine)
            pb.append(other)
        bounds = [np.concatenate([[0], np.cumsum([len(x) for x in p])]).astype(np.int64) for p in (pa_, pb)]
        return np.concatenate(pa_), bounds[0], np.concatenate(pb).astype(np.int32), bounds[1]


def load(bytes_file: str = BYTES_FILE, pieces_file: str = PIECES_FILE) -> Pair:
    with open(pieces_file, "rb") as model:
        return Pair(bytebpe.load_json(bytes_file), Pieces(model.read()))


# --- alignment ----------------------------------------------------------------------------------


def lanes(ea: np.ndarray, eb: np.ndarray, size: int = LANE):
    """Indices (i, j) of tokens that begin at common ends, about ``size`` tokens apart."""
    i = np.arange(size, len(ea), size)
    j = np.searchsorted(eb, ea[i - 1])
    while True:
        off = np.flatnonzero(eb[j] != ea[i - 1])
        if not len(off):
            break
        i[off] += 1
        j[off] = np.searchsorted(eb, ea[i[off] - 1])
    i, j = np.concatenate([[0], i]), np.concatenate([[0], j + 1])
    new = np.ones(len(i), bool)
    new[1:] = i[1:] > i[:-1]
    new &= i < len(ea)
    return i[new], j[new]


def align(ea: np.ndarray, eb: np.ndarray, size: int = LANE):
    """Group ends of two arrays of token ends over the same bytes (both ascending, with the same last
    value): for each group, one past its last token in A and in B."""
    if not len(ea):
        none = np.zeros(0, np.int64)
        return none, none
    in_a, in_b = np.zeros(len(ea), bool), np.zeros(len(eb), bool)
    i, j = lanes(ea, eb, size)
    stop, stop_b = np.append(i[1:], len(ea)), np.append(j[1:], len(eb))
    probe = np.ones(len(i), np.int64)
    while len(i):
        # an exponential probe at each lane's shift j - i
        n = np.minimum(probe, np.minimum(stop - i, stop_b - j))
        head = np.cumsum(n) - n
        k = np.arange(head[-1] + n[-1]) - np.repeat(head, n)
        at_a, at_b = np.repeat(i, n) + k, np.repeat(j, n) + k
        same = ea[at_a] == eb[at_b]
        m = np.minimum.reduceat(np.where(same, np.repeat(n, n), k), head)
        run = k < np.repeat(m, n)
        in_a[at_a[run]] = True
        in_b[at_b[run]] = True
        i, j = i + m, j + m
        probe = np.where(m == n, probe * 2, 1)
        odd = np.flatnonzero(m < n)
        if len(odd):  # the lagging side goes on until both end at the same byte
            x, y = i[odd], j[odd]
            left = np.arange(len(odd))
            while len(left):
                a, b = ea[x[left]], eb[y[left]]
                x[left] += a < b
                y[left] += a > b
                left = left[a != b]
            in_a[x] = True
            in_b[y] = True
            i[odd], j[odd] = x + 1, y + 1
        go = i < stop
        if not go.all():
            i, j, stop, stop_b, probe = i[go], j[go], stop[go], stop_b[go], probe[go]
    return np.flatnonzero(in_a) + 1, np.flatnonzero(in_b) + 1


def linked(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, doc: np.ndarray):
    """Links of groups (group ends in A and B, document of each): (document, a << 32 | b, weight),
    where a pair may come several times."""
    na, nb = np.diff(ga, prepend=0), np.diff(gb, prepend=0)
    a0, b0, links = ga - na, gb - nb, na * nb
    small = np.flatnonzero(links <= LARGE)
    n = links[small]
    at = np.repeat(np.cumsum(n) - n, n)
    k = np.arange(len(at)) - at
    wide = np.repeat(nb[small], n)
    key = a[np.repeat(a0[small], n) + k // wide].astype(np.int64) << 32 | b[np.repeat(b0[small], n) + k % wide]
    out = [(np.repeat(doc[small], n), key, np.ones(len(key), np.int64))]
    for g in np.flatnonzero(links > LARGE):
        x, nx = np.unique(a[a0[g] : ga[g]], return_counts=True)
        y, ny = np.unique(b[b0[g] : gb[g]], return_counts=True)
        out.append((np.full(len(x) * len(y), doc[g]), (x.astype(np.int64)[:, None] << 32 | y).ravel(), (nx[:, None] * ny).ravel()))
    return [np.concatenate(c) for c in zip(*out)]


def _signs(length: int, ends: np.ndarray) -> np.ndarray:
    """0 within a group, 1 at its last token."""
    out = np.zeros(length, np.int64)
    out[ends - 1] = 1
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers (0 or more) in the smallest unsigned type that holds them."""
    return x.astype(np.min_scalar_type(x.max(initial=0)))


def part_rows(pair: Pair, data: np.ndarray, off: np.ndarray) -> dict:
    """All that one part of a slab gives."""
    (a, at, ea), (b, bt, eb) = pair.encode(data, off)
    ga, gb = align(ea, eb)
    docs = len(off) - 1
    doc = np.searchsorted(at, ga - 1, side="right") - 1
    d, key, weight = linked(a, b, ga, gb, doc)
    pairs, which = np.unique(key, return_inverse=True)
    at_pair = d * len(pairs) + which
    if weight.max(initial=1) == 1:
        held, weight = np.unique(at_pair, return_counts=True)
    else:
        held, where = np.unique(at_pair, return_inverse=True)
        total = np.zeros(len(held), np.int64)
        np.add.at(total, where, weight)
        weight = total
    holder, entry = (held // len(pairs), held % len(pairs)) if len(pairs) else (held, held)
    links = np.concatenate([[0], np.cumsum(weight)])
    end = np.searchsorted(holder, np.arange(docs), side="right")
    begin = np.concatenate([[0], end[:-1]])
    # the groups as text: A's and B's tokens in turn
    merged = np.empty(len(a) + len(b), np.int64)
    if len(ga):
        merged[np.arange(len(a)) + np.repeat(gb - np.diff(gb, prepend=0), np.diff(ga, prepend=0))] = a.astype(np.int64) * 6 + _signs(len(a), ga)
        merged[np.arange(len(b)) + np.repeat(ga, np.diff(gb, prepend=0))] = b.astype(np.int64) * 6 + 3 + _signs(len(b), gb)
    text = pair.decimals(int(max(a.max(initial=-1), b.max(initial=-1))) + 1)
    parts = list(map(text.__getitem__, merged.tolist()))
    bounds = (at + bt).tolist()
    sha = [hashlib.sha256(b"".join(parts[x:y])[:-1]).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])]
    groups = np.searchsorted(ga, at, side="right")
    return {
        "n_a": np.diff(at), "n_b": np.diff(bt), "n_groups": np.diff(groups), "n_links": links[end] - links[begin], "groups_sha256": sha,
        "pairs": pairs, "end": end, "entry": _narrow(entry), "weight": _narrow(weight),
    }


def slab_rows(parts: list[dict]) -> dict:
    """All that a slab gives: its parts one after the other, with one list of distinct pairs."""
    pairs = np.unique(np.concatenate([p["pairs"] for p in parts]))
    out = {k: np.concatenate([p[k] for p in parts]) for k in ("n_a", "n_b", "n_groups", "n_links", "weight")}
    entry = np.concatenate([np.searchsorted(pairs, p["pairs"])[p["entry"]] for p in parts])
    before = np.cumsum([0, *(len(p["entry"]) for p in parts)])
    end = np.concatenate([p["end"] + n for p, n in zip(parts, before)])
    sha = [x for p in parts for x in p["groups_sha256"]]
    return {**out, "groups_sha256": sha, "pairs": pairs, "docs": np.bincount(entry, minlength=len(pairs)), "end": end, "entry": _narrow(entry)}


# --- Spark ----------------------------------------------------------------------------------------

_SLABS = "slab bigint, pairs array<bigint>, docs array<bigint>, rest binary"
_DOCUMENT = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "end"]
_ENTRY = ["entry", "weight"]


def _packed(*batches: pa.RecordBatch) -> bytes:
    """Batches as one value, so that the JVM moves them without looking at their elements."""
    sink = pa.BufferOutputStream()
    for batch in batches:
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> list[pa.RecordBatch]:
    source = pa.BufferReader(value)
    return [list(pa.ipc.open_stream(source))[0] for _ in range(2)]


def _slab_parts(pair: Pair, batches, size: int, part: int, most: int):
    """(document ids, parts of up to ``part`` bytes) of each slab: as many documents, ``most`` at most, as fit
    ``size`` bytes, from any number of batches."""
    ids, parts, held, rows = [], [], 0, 0
    for batch in batches:
        for i, j, data, off in text_slices(batch.column(1), min(size, part)):
            if parts and (held + len(data) > size or rows + j - i > most):
                yield ids, parts
                ids, parts, held, rows = [], [], 0, 0
            # a copy: a slice would hold on to the whole batch
            ids.append(batch.column(0).take(pa.array(np.arange(i, j))))
            parts.append(part_rows(pair, data, off))
            held, rows = held + len(data), rows + j - i
    if parts:
        yield ids, parts


def _slabs_arrow(shared):
    def run(batches):
        n = TaskContext.get().partitionId() << 32
        for ids, parts in _slab_parts(shared.value, batches, SLAB, PART, ROWS):
            got = slab_rows(parts)
            documents = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *(pa.array(got[k]) for k in _DOCUMENT)], ["doc_id", *_DOCUMENT])
            entries = pa.RecordBatch.from_arrays([pa.array(got[k]) for k in _ENTRY], _ENTRY)
            cols = [pa.array([n], pa.int64()), *(pa.array([got[k]], pa.list_(pa.int64())) for k in ("pairs", "docs"))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([_packed(documents, entries)], pa.binary())], ["slab", "pairs", "docs", "rest"])
            n += 1

    return run


def slabs(docs: DataFrame, bytes_file: str = BYTES_FILE, pieces_file: str = PIECES_FILE) -> DataFrame:
    """The written table of slabs: a row for a few MB of text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(bytes_file, pieces_file))
    text = F.when(F.length("text") > 0, F.concat(F.lit(" "), "text")).otherwise(F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).mapInArrow(tidy(_slabs_arrow(shared)), _SLABS)
    groups = {"parquet.block.size": BATCH, "parquet.block.size.row.check.min": 4, "parquet.page.size.row.check.min": 4}
    with small_batches(docs.sparkSession, BATCH):
        return materialize(rows, "alignment", groups)


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, n, best) of a table of slabs: how many documents hold the id pair linked (A id << 32 | B id), and whether
    that is the highest count of its A id."""
    each = table.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.docs").alias("n"))
    total = each.groupBy("pair").agg(F.sum("n").alias("n"))
    # an A id's window has a row for each B id it is linked to: at most the vocabulary
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return total.select("pair", "n", (F.col("n") == top).alias("best"))


def _finish_arrow():
    def close(rest, found):
        documents, entries = _unpacked(rest)
        if found:
            n, best = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        else:
            n, best = np.zeros(0, np.int64), np.zeros(0, bool)
        end, entry, weight = documents["end"].to_numpy(), entries["entry"].to_numpy(), entries["weight"].to_numpy()
        weight = weight.astype(np.int64)
        begin = np.concatenate([[0], end[:-1]])
        cols = [documents[k] for k in ("doc_id", *_DOCUMENT[:-1])]
        for each in (np.where(best[entry], weight, 0), weight * n[entry]):
            total = np.concatenate([[0], np.cumsum(each)])
            cols.append(pa.array(total[end] - total[begin]))
        return pa.RecordBatch.from_arrays(cols, ["doc_id", *_DOCUMENT[:-1], "n_best", "count_sum"])

    def run(batches):
        """Rows come by slab: the slab itself, then the counts of its pairs in order."""
        slab, found = None, []
        for batch in batches:
            heads = np.flatnonzero(batch.column(1).to_numpy(zero_copy_only=False) < 0).tolist()
            at = 0
            for h in [*heads, batch.num_rows]:
                if h > at:
                    found.append((batch.column(2).slice(at, h - at).to_numpy(), batch.column(3).slice(at, h - at).to_numpy(zero_copy_only=False)))
                if h < batch.num_rows:
                    if slab is not None:
                        yield close(slab, found)
                    slab = batch.column(4)[h].as_py()
                    found = []
                at = h + 1
        if slab is not None:
            yield close(slab, found)

    return run


def digests(docs: DataFrame, bytes_file: str = BYTES_FILE, pieces_file: str = PIECES_FILE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row's whole text."""
    table = slabs(docs, bytes_file, pieces_file)
    counts = materialize(pair_counts(table), "pair-counts")
    asked = table.select("slab", F.posexplode("pairs").alias("pos", "pair")).join(counts, "pair").select("slab", "pos", "n", "best")
    heads = table.select("slab", F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("best"), "rest")
    both = heads.unionByName(asked.withColumn("rest", F.lit(None).cast("binary"))).repartition("slab").sortWithinPartitions("slab", "pos")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = both.select("slab", "pos", "n", "best", "rest").mapInArrow(tidy(_finish_arrow()), schema)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _groups_arrow(shared):
    def run(batches):
        pair = shared.value
        for batch in batches:
            for i, j, data, off in text_slices(batch.column(1), min(SLAB, PART)):
                (a, at, ea), (b, bt, eb) = pair.encode(data, off)
                ga, gb = align(ea, eb)
                cut = np.searchsorted(ga, at, side="right")
                base = np.diff(cut)
                lists = [(a, at), (b, bt), (ga - np.repeat(at[:-1], base), cut), (gb - np.repeat(bt[:-1], base), cut)]
                cols = [pa.ListArray.from_arrays(pa.array(c.astype(np.int32)), pa.array(x.astype(np.int32))) for x, c in lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *cols], ["row", "a", "b", "ends_a", "ends_b"])

    return run


def aligned(docs: DataFrame, bytes_file: str = BYTES_FILE, pieces_file: str = PIECES_FILE) -> DataFrame:
    """All rows of ``docs`` without the text, with the ids ``a`` and ``b`` of both tokenizers and of
    each group the index behind its last token in each (``ends_a``, ``ends_b``).  Columns of those names make way."""
    shared = docs.sparkSession.sparkContext.broadcast(load(bytes_file, pieces_file))
    new = ["a", "b", "ends_a", "ends_b"]
    others = [c for c in docs.columns if c != "text" and c not in new]
    text = F.when(F.length("text") > 0, F.concat(F.lit(" "), "text")).otherwise(F.lit(""))
    src = docs.select(F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in others]).alias("row"), text.alias("text"))
    schema = T.StructType([src.schema["row"], *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in new]])
    return src.mapInArrow(tidy(_groups_arrow(shared)), schema).select(*[F.col("row").getField(c).alias(c) for c in others], *new)

"""Helpers shared by the training-data operators: Arrow text buffers, word and n-gram
hashing over whole batches, bounded training samples and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.session import materialize

MASK64 = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
#: Bytes of text that the array code works on at a time; its temporaries are some 50 times that.
_SLICE = 1 << 19


def crc_mod(key: str, m: int) -> Column:
    """crc32 of the key as text, modulo m (-1 for a null key)."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(m)), F.lit(-1))


def text_slices(arr, max_bytes: int = _SLICE):
    """Cut an Arrow string array into runs of documents of about ``max_bytes``: yields
    (first row, end row, uint8 bytes, int64 offsets from 0).  Null counts as empty.  One
    document longer than ``max_bytes`` is a run of its own, never cut."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    n = len(arr)
    if not n:
        return
    wide = pa.types.is_large_string(arr.type)
    off = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _byte_codes(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


_CODES = _byte_codes()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(1, n), base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


class RollingHash:
    """Polynomial hash (mod 2**64, random byte codes) of any substring of a byte run:
    two prefix sums and one power per substring."""

    _pow = _powers(_R, 1 << 12)
    _inv = _powers(_R_INV, 1 << 12)

    def __init__(self, data: np.ndarray):
        n = len(data)
        cls = RollingHash
        if len(cls._pow) <= n:
            size = max(n + 1, _SLICE + (1 << 16))
            cls._pow, cls._inv = _powers(_R, size), _powers(_R_INV, size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data] * cls._pow[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * RollingHash._inv[start])

    def windows(self, width: int) -> np.ndarray:
        """Hash of every substring of ``width`` bytes, by start."""
        n = len(self.sums) - 1 - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix64((self.sums[width:] - self.sums[:n]) * RollingHash._inv[:n])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, off: np.ndarray):
    """Starts and ends of the words (runs of bytes other than ASCII white space) of a run
    of documents; no word crosses a document end."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z
    ink = ~_SPACE[data]
    before = np.empty(len(ink), bool)
    before[0] = False
    before[1:] = ink[:-1]
    heads = off[:-1][off[:-1] < len(data)]
    before[heads] = False
    start = np.flatnonzero(ink & ~before)
    after = np.empty(len(ink), bool)
    after[-1] = False
    after[:-1] = ink[1:]
    tails = off[1:] - 1
    after[tails[(tails >= 0)]] = False
    end = np.flatnonzero(ink & ~after) + 1
    return start, end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def group_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i+1]] for each i (0 for an empty range).  Each range is summed by
    itself, so equal ranges have equal sums whatever stands before them."""
    out = np.zeros((len(bounds) - 1,) + values.shape[1:], np.float64)
    live = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(live):
        # between the starts of two non-empty ranges lies one range
        out[live] = np.add.reduceat(values.astype(np.float64, copy=False)[: bounds[-1]], bounds[:-1][live], axis=0)
    return out


def whole_rows(df: DataFrame, leave: tuple[str, ...] = ()) -> Column:
    """One struct of all columns (but ``leave``), whatever their names hold."""
    return F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in df.columns if c not in leave]).alias("row")


def unpacked(df: DataFrame, columns: list[str], row: str = "row") -> DataFrame:
    """The columns of a struct that ``whole_rows`` made."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in columns])


def row_key(df: DataFrame, column: str = "doc_id") -> Column:
    """A long for an id of any type: itself, if it is a whole number; null stays null."""
    kind = df.schema[column].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(f"`{column}`").cast("long")
    return F.when(F.col(f"`{column}`").isNotNull(), F.xxhash64(F.col(f"`{column}`")))


def bounded_sample(rows: DataFrame, by: str, key: str, per_class: int, seed: int = 11) -> DataFrame:
    """About ``per_class`` rows of each value of ``by`` (all, where there are fewer), chosen
    by a keyed hash of ``key``, so the same rows come back on every run.  The class counts
    go over all rows; their number is the number of classes."""
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect() if r[0] is not None}
    if not counts:
        return rows.filter(F.lit(False))
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(by) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    point = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.filter(point < share)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected edge list: (node, root), root the smallest
    node reachable, for nodes with an edge.  Alternates large-star and small-star steps;
    both aggregate before they shuffle.  Each round is written to the shared folder."""
    spark = edges.sparkSession
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    cur = materialize(cur, "components")
    state = None
    while True:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        )
        nxt = materialize(small, "components")
        seen = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        cur = nxt
        if state == tuple(seen):
            break
        state = tuple(seen)
    del spark
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def tidy(run):
    """A mapInArrow function that, at the end of its task, hands freed memory back to the system: Python workers are
    reused, and what their allocators hold on to would count against the executor all along."""

    def task(batches):
        yield from run(batches)
        _release()

    return task


def _release() -> None:
    """Freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU allocator's
    if trim:
        trim(0)


def hand_back(spark) -> None:
    """What ``tidy`` does, for the driver: large values that went through it leave a grown heap, in Python and in
    the JVM."""
    _release()
    spark.sparkContext._jvm.java.lang.System.gc()


@contextmanager
def small_batches(spark, size: int):
    """Within this block, batches for Python tasks end at ``size`` bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package to the executors once per application (as ``--py-files`` would),
    so that Python workers can import it wherever the session was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int):
    """Training rows (k, t, y) of classes 0 and 1, and the two classes' counts over all the
    labels whose crc32(doc_id) mod 5 is not 0.  The keys are sampled from the labels first,
    so that only a bounded table is broadcast and no text is shuffled."""
    train = labels.filter(crc_mod("doc_id", 5) != 0).select(F.col("doc_id").alias("k"), F.col(label).cast("int").alias("y"))
    train = train.filter("k is not null and y in (0, 1)").dropDuplicates(["k", "y"])
    counts = {r[0]: r[1] for r in train.groupBy("y").count().collect()}
    keys = F.broadcast(bounded_sample(train, "y", "k", per_class))
    texts = docs.select(F.col("doc_id").alias("k"), F.coalesce("text", F.lit("")).alias("t"))
    # a key may stand on any number of rows: one text of each
    rows = texts.join(keys, "k").groupBy("k", "y").agg(F.min("t").alias("t"))
    rows = sorted(rows.select("k", "t", "y").collect(), key=lambda r: (r["k"], r["y"], r["t"]))
    return rows, np.array([counts.get(0, 0), counts.get(1, 0)], np.float64)

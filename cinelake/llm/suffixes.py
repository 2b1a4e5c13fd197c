"""Exact removal of long repeated byte strings with a logarithmic family of sparse suffix
arrays.

Sampling.  Every window of ``match`` bytes has one seed: the ``seed``-byte string of smallest
hash in it, the leftmost of equals.  Which seed that is depends on the window's bytes alone,
so equal windows have equal seeds at equal offsets, and about 2 / (match - seed) of all
suffixes suffice.  Neighbouring windows with one seed form a range.

Index family.  A batch of documents gets the sorted array of its sampled suffixes (ordered by
the 64-bit fingerprint of the seed): key, number of occurrences, smallest and largest
fingerprint of the surrounding range.  A new batch is merge-scanned with the levels for keys
they share; these scans give the repeated keys.  Levels of equal size merge before the next batch, so n batches
leave at most log2(n) + 1 levels and every suffix is rewritten log2(n) times; merged levels are dropped.  Levels are tables bucketed and sorted by key in the
shared folder: merging two is a merge join without a shuffle.

Resolving.  Ranges whose key occurs once hold no repeated window.  Where all ranges of a key
are equal, or this one has an equal, the whole range repeats.  Only the others, at the edges
of repeated passages, are compared byte window by byte window, in groups of one key; keys
with more than ``HOT`` different open ranges are counted window by window with a distributed
aggregate instead, so that no such group meets in one task.  Strings are compared by 64-bit fingerprints
within one key's 64-bit fingerprint.

Defined cases: null text is empty; documents under ``match`` bytes lose nothing; repeated
rows repeat each other's strings, so both lose them; a null doc_id is a document like others.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.llm.common import mix64, RollingHash, row_key, text_slices, tidy, whole_rows
from cinelake.session import materialize, remove_path, shared_dir

MATCH = 200
SEED = 40
#: Ranges of a key (under 400 bytes each) that one task compares at a time.
HOT = 16384
#: Batches that the query inserts one after the other.
BATCHES = 4

_LOW = np.uint64((1 << 24) - 1)


def sampled(data: np.ndarray, off: np.ndarray, match: int = MATCH, seed: int = SEED):
    """Ranges of the windows of a run of documents (under 16 MB, or one document): arrays of
    document, first window start, number of windows, key and range fingerprint."""
    none = np.zeros(0, np.int64)
    if len(data) < match:
        return none, none, none, none, none
    roll = RollingHash(data)
    hashes = roll.windows(seed)
    width = match - seed + 1
    parts, block = [], (1 << 24) - width  # positions in a block fit into 24 bits
    for base in range(0, len(data) - match + 1, block):
        h = hashes[base : base + block + width - 1]
        v = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= width:  # minimum over ``width`` by doubling
            v = np.minimum(v[:-span], v[span:])
            span *= 2
        if span < width:
            v = np.minimum(v[: len(v) - (width - span)], v[width - span :])
        parts.append((v & _LOW).astype(np.int64) + base)
    at = np.concatenate(parts)
    head = np.ones(len(at), bool)
    head[1:] = at[1:] != at[:-1]
    head[off[1:-1][off[1:-1] < len(at)]] = True
    start = np.flatnonzero(head)
    end = np.append(start[1:], len(at))
    doc = np.searchsorted(off, start, side="right") - 1
    end = np.minimum(end, off[doc + 1] - match + 1)  # windows stay in their document
    ok = end > start
    start, end, doc = start[ok], end[ok], doc[ok]
    s = at[start]
    shape = ((s - start) * 1000 + (end - start)).astype(np.uint64)
    ctx = roll.of(start, end - 1 + match) ^ mix64(shape)
    return doc, start, end - start, hashes[s].view(np.int64), ctx.view(np.int64)


def _slices(column):
    return text_slices(column)


def _entries_arrow(match: int, seed: int):
    def run(batches):
        for batch in batches:
            for _, _, data, off in _slices(batch.column(0)):
                _, _, _, key, ctx = sampled(data, off, match, seed)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ctx)], ["key", "ctx"])

    return run


def _occurrences_arrow(match: int, seed: int):
    def run(batches):
        for batch in batches:
            k, h = (batch.column(i).to_numpy() for i in (0, 1))
            for i, _, data, off in _slices(batch.column(2)):
                doc, start, n, key, ctx = sampled(data, off, match, seed)
                at = ((start - off[doc]) << 8) | n
                cols = [k[doc + i], h[doc + i], key, ctx, at]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["k", "h", "key", "ctx", "at"])

    return run


def _bucketed(df: DataFrame, keys: list[str], purpose: str) -> str:
    """``df`` written to the shared folder as a table bucketed and sorted by ``keys``; returns its name."""
    spark = df.sparkSession
    name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, *keys).sortBy(*keys).option("path", shared_dir(spark, purpose)).format("parquet").saveAsTable(name)
    return name


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table of ``_bucketed`` and its files: nothing reads it any more."""
    folder = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {name}")
    remove_path(spark, folder)


class IndexFamily:
    """Levels of sorted suffix arrays: one of rank r holds 2**r batches.  Two levels of one rank
    merge before the next batch comes, and the tables they were go."""

    def __init__(self, spark: SparkSession, match: int = MATCH, seed: int = SEED):
        self.spark, self.match, self.seed = spark, match, seed
        self.levels: list[tuple[int, str]] = []  # (rank, table), highest rank first
        self.matches: list[DataFrame] = []  # what the scans of the batches found

    def suffix_array(self, texts: DataFrame) -> DataFrame:
        """The array of a batch (column ``text``): key, n, low, high."""
        entries = texts.select("text").mapInArrow(tidy(_entries_arrow(self.match, self.seed)), "key long, ctx long")
        return entries.groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("low"), F.max("ctx").alias("high"))

    def scan(self, array: DataFrame) -> DataFrame:
        """Merge-scan: keys that an array, or it and the levels, hold more than once, over all of these: key, n, low, high."""
        found = array
        for _, table in self.levels:
            found = self.merge(found, self.spark.table(table), "left")
        return found.filter("n > 1")

    @staticmethod
    def merge(a: DataFrame, b: DataFrame, how: str = "full") -> DataFrame:
        b = b.select("key", *(F.col(c).alias(f"{c}_b") for c in ("n", "low", "high")))
        both = a.join(b, "key", how)
        return both.select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.coalesce("n_b", F.lit(0))).alias("n"),
            F.least("low", "low_b").alias("low"),
            F.greatest("high", "high_b").alias("high"),
        )

    def _carry(self) -> None:
        """Merge levels of one rank, geometrically."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels[-2:]
            table = _bucketed(self.merge(self.spark.table(a), self.spark.table(b)), ["key"], "suffix-array")
            self.levels[-2:] = [(rank + 1, table)]
            drop_table(self.spark, a)
            drop_table(self.spark, b)

    def insert(self, texts: DataFrame) -> DataFrame:
        """Add a batch; returns the merge-scan of its array with the levels before it, written."""
        self._carry()
        table = _bucketed(self.suffix_array(texts), ["key"], "suffix-array")
        self.matches.append(materialize(self.scan(self.spark.table(table)), "suffix-matches"))
        self.levels.append((0, table))
        return self.matches[-1]

    def repeated(self) -> DataFrame:
        """Keys that occur more than once in all batches: (key, alike).  The scan of the last batch that holds a
        key has seen all its occurrences, so the scans together have every repeated key and its ends."""
        found = None
        for m in self.matches:
            found = m if found is None else found.unionByName(m)
        ends = found.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        return ends.select("key", (F.col("low") == F.col("high")).alias("alike"))

    def close(self) -> None:
        """Drop all levels."""
        for _, table in self.levels:
            drop_table(self.spark, table)
        self.levels = []


# --- resolving the edges -----------------------------------------------------------------


def _windows(texts: pa.Array, match: int):
    """Fingerprint of every window of a binary array's values: (row, offset, hash)."""
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    n = np.diff(off) - match + 1
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = off[row] + place
    return row, place, RollingHash(data).of(at, at + match)


def _contexts_arrow(match: int):
    """Bytes around every open range of a document."""

    def run(batches):
        for batch in batches:
            k, h, text, opens = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                raw = text[i].as_buffer()
                rows = [(k[i].as_py(), h[i].as_py(), o["key"], o["n"], o["at"] >> 8, raw[o["at"] >> 8 : (o["at"] >> 8) + (o["at"] & 255) - 1 + match].to_pybytes()) for o in opens[i].as_py()]
                if rows:
                    cols = list(zip(*rows))
                    kinds = [pa.int64()] * 5 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["k", "h", "key", "n", "start", "bytes"])

    return run


def _chunks(batches, limit: int = 4000):
    """Tables of whole groups: rows come sorted by key, and a group is never cut."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, limit))
            rows += held[-1].num_rows
            batch = batch.slice(held[-1].num_rows)
            if rows >= limit:
                table = pa.Table.from_batches(held).combine_chunks()
                key = table["key"].to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                rows = table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _edges_arrow(match: int):
    """Repeated windows within each key's group, as packed spans."""

    def run(batches):
        for table in _chunks(batches):
            table = table.combine_chunks()
            key = table["key"].to_numpy()
            row, place, h = _windows(table["bytes"].chunk(0), match)
            _, inv, n = np.unique(h ^ mix64(key[row].view(np.uint64)), return_inverse=True, return_counts=True)
            hit = n[inv] > 1
            row, place = row[hit], place[hit]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
            last = np.append(first[1:], True) if len(row) else first
            r = row[first]
            base = table["start"].to_numpy()[r]
            span = ((base + place[first]) << 32) | (base + place[last] + match)
            yield pa.RecordBatch.from_arrays([pa.array(table["k"].to_numpy()[r]), pa.array(table["h"].to_numpy()[r]), pa.array(span)], ["k", "h", "span"])

    return run


def _hot_windows_arrow(match: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for i in range(0, batch.num_rows, 4000):
                part = batch.slice(i, 4000)
                row, place, h = _windows(part.column(5), match)
                k, hh, key, _, start = (part.column(c).to_numpy() for c in range(5))
                at = start[row] + place
                cols = [k[row], hh[row], key[row], h.view(np.int64), (at << 32) | (at + match)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["k", "h", "key", "w", "span"])

    return run


def _edges(contexts: DataFrame, match: int) -> DataFrame:
    """(k, h, span) of the repeated windows among the contexts."""
    few = contexts.filter(F.col("n") <= HOT).repartition("key").sortWithinPartitions("key")
    cold = few.mapInArrow(tidy(_edges_arrow(match)), "k long, h long, span long")
    hot = contexts.filter(F.col("n") > HOT).mapInArrow(tidy(_hot_windows_arrow(match)), "k long, h long, key long, w long, span long")
    again = hot.groupBy("key", "w").count().filter("count > 1").select("key", "w")
    return cold.union(hot.join(again, ["key", "w"], "left_semi").select("k", "h", "span"))


def merged_spans(packed: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of packed (start << 32 | end) spans."""
    out: list[list[int]] = []
    for p in np.sort(packed).tolist():
        s, e = p >> 32, p & 0xFFFFFFFF
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _finish_arrow(with_text: bool):
    def run(batches):
        for batch in batches:
            text, sure, edge = (batch.column(i) for i in (1, 2, 3))
            out = []
            for i in range(batch.num_rows):
                raw = (text[i].as_py() or "").encode()
                found = [x.values.to_numpy() for x in (sure[i], edge[i]) if x.is_valid and len(x)]
                spans = merged_spans(np.concatenate(found)) if found else []
                kept, at = [], 0
                for s, e in spans:
                    kept.append(raw[at:s])
                    at = e
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if with_text else None))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            cols = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["row", *(x.split()[0] for x in DIGEST.split(", "))])

    return run


def _removed(docs: DataFrame, match: int, seed: int, batches: int, with_text: bool) -> DataFrame:
    """``row`` (the other columns of ``docs``, and whether the text was null) and DIGEST, with the rest of the text in
    ``kept`` if asked for (a character that a removal cut is dropped there)."""
    spark = docs.sparkSession
    src = docs.select(
        F.struct(whole_rows(docs, ("text",)).alias("cols"), F.isnull("text").alias("none")).alias("row"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(row_key(docs), F.lit(-(1 << 63))).alias("k"),
    ).withColumn("h", F.xxhash64("text"))
    family = IndexFamily(spark, match, seed)
    for b in range(batches):
        family.insert(src.filter(F.pmod(F.xxhash64("k"), F.lit(batches)) == b))
    # as a plain table: both sides of the join below shuffle, so AQE can split a hot key
    again = materialize(family.repeated(), "suffix-keys")
    family.close()
    places = src.select("k", "h", "text").mapInArrow(tidy(_occurrences_arrow(match, seed)), "k long, h long, key long, ctx long, at long")
    mixed = [F.when(~F.col("alike"), F.col(c)).alias(c) for c in ("key", "ctx")]
    places = materialize(places.join(again, "key").select("k", "h", "at", "alike", *mixed), "suffix-places")
    whole = places.filter("alike")
    mixed = places.filter("not alike")
    # of equal ranges one stays open, as the others' evidence, if its key has odd ones
    one = F.struct("k", "h", "at")
    equal = mixed.groupBy("key", "ctx").agg((F.count("*") > 1).alias("same"), F.min(one).alias("one"))
    equal = equal.join(equal.groupBy("key").agg((~F.min("same")).alias("odd"), F.count("*").alias("n")), "key")
    mixed = mixed.join(equal, ["key", "ctx"])
    show = ~F.col("same") | (F.col("odd") & (F.col("one") == one))
    first = F.shiftright("at", 8)
    span = F.shiftleft(first, 32).bitwiseOR(first + F.col("at").bitwiseAND(F.lit(255)) - 1 + match)
    nothing = F.lit(None).cast("struct<key:bigint,n:bigint,at:bigint>")
    marks = whole.select("k", "h", span.alias("span"), nothing.alias("open")).union(
        mixed.select("k", "h", F.when(F.col("same"), span).alias("span"), F.when(show, F.struct("key", "n", "at")).alias("open"))
    )
    marks = marks.groupBy("k", "h").agg(F.collect_list("span").alias("spans"), F.collect_list("open").alias("opens"))
    marked = src.join(marks, ["k", "h"], "left")
    is_open = F.coalesce(F.size("opens") > 0, F.lit(False))
    marked = spark.table(_bucketed(marked.select("row", "text", "k", "h", "spans", "opens", is_open.alias("open")), ["k", "h"], "suffix-documents"))
    for df in (again, places, *family.matches):  # read for the last time
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            remove_path(spark, folder)
    contexts = materialize(
        marked.filter("open").select("k", "h", "text", "opens").mapInArrow(tidy(_contexts_arrow(match)), "k long, h long, key long, n long, start long, bytes binary"),
        "suffix-contexts",
    )
    edges = _edges(contexts, match).groupBy("k", "h").agg(F.collect_list("span").alias("edges"))
    done = marked.select("row", "text", "spans", "k", "h").join(edges, ["k", "h"], "left").select("row", "text", "spans", "edges")
    schema = T.StructType([src.schema["row"], *T._parse_datatype_string(DIGEST).fields])
    return done.mapInArrow(tidy(_finish_arrow(with_text)), schema)


def remove_repeats(docs: DataFrame, match: int = MATCH, seed: int = SEED, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs``; see the
    contract of op6."""
    found = _removed(docs.select("doc_id", "text"), match, seed, batches, False)
    return found.select("row.cols.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, match: int = MATCH, seed: int = SEED, batches: int = BATCHES) -> DataFrame:
    """All rows of ``docs`` with what is left of the text, and its length in ``n_chars`` if
    there is such a column.  Texts without a removal, nulls too, stay as they are."""
    found = _removed(docs, match, seed, batches, True)
    cols = {"text": F.when(~F.col("row.none"), F.col("kept"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cols["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(kind)).otherwise(F.col("row.cols.n_chars"))
    return found.select(*[cols[c].alias(c) if c in cols else F.col("row.cols").getField(c).alias(c) for c in docs.columns])

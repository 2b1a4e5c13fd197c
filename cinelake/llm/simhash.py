"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: lower-cased A-Z, words of bytes other than ASCII white space, word shingles
(repeats included), XXH64 with seed 42 of each, majority of every bit over the shingles.

Covering masks for radius r: bit b carries a non-zero code m(b) of r + 1 bits; the table of
a non-zero vector v keeps the bits with <m(b), v> = 1 (mod 2).  Any r codes are orthogonal
to a common v, so every pair within r bits agrees in some table: no pair is missed.

Only distinct fingerprints go on.  A table's bucket of a few fingerprints is compared pair
by pair.  Larger buckets never form pairs: two fingerprints of a bucket are within two bits
exactly if the balls of radius one around them, in the bucket's free bits, meet, so each
fingerprint lists its ball and all that meet in a point are linked to the smallest there.
Both ways are exact, and rows stay in proportion to the fingerprints.

Defined cases: null and empty texts, and texts of white space alone, have no word: their
fingerprint is zero and links like any other.  Fewer words than a shingle: one shingle of
them all.  Repeated rows fall into one component; a null doc_id never becomes a
component_id unless all of its component are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import components, unpacked, whole_rows
from cinelake.session import materialize

#: Buckets up to this many fingerprints are compared pairwise (at most 3.5 pairs a row).
PAIRWISE = 8

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: Column, size: int) -> Column:
    """XXH64 (seed 42) of every ``size``-word shingle of a text, in order."""
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    words = F.filter(F.split(folded, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", F.slice(w, i, size))))
        return F.when(F.size(w) > 0, hashes).otherwise(F.array().cast("array<bigint>"))

    # bound as a lambda's argument, the words are split once and not once for each shingle
    return F.transform(F.array(words), of)[0]


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprint of hashes[bounds[i]:bounds[i+1]]: bits set in over half of them."""
    n = np.diff(bounds)
    out = np.zeros(len(n), np.uint64)
    live = np.flatnonzero(n)
    if not len(live):
        return out
    # eight byte-wide counters in a word; runs of at most 255 hashes cannot overflow them
    cuts = [np.arange(bounds[i], bounds[i + 1], 255) for i in live]
    owner = np.repeat(np.arange(len(live)), [len(c) for c in cuts])
    cuts = np.concatenate(cuts)
    first = np.searchsorted(owner, np.arange(len(live)))
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, cuts)
        counts = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        total = np.add.reduceat(counts, first, axis=0)
        for byte in range(8):
            bit = np.uint64(8 * byte + shift)
            out[live] |= (2 * total[:, byte] > n[live]).astype(np.uint64) << bit
    return out


def _fingerprint_arrow(batches):
    """The first column's lists of hashes become fingerprints, behind the other columns."""
    for batch in batches:
        hashes = batch.column(0)
        off = np.frombuffer(hashes.buffers()[1], np.int32)[hashes.offset : hashes.offset + len(hashes) + 1].astype(np.int64)
        values = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
        fp = majority(values[off[0] : off[-1]], off - off[0]) if len(hashes) else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp.view(np.int64))], [*batch.schema.names[1:], "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint of every row's whole text."""
    return _with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp")


def _with_fingerprint(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, the text's hash ``t`` and its fingerprint ``fp``."""
    src = docs.select(shingle_hashes(F.col("text"), shingle).alias("h"), "doc_id", F.xxhash64("text").alias("t"))
    return src.mapInArrow(_fingerprint_arrow, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, t long, fp long")


def covering_masks(radius: int) -> list[int]:
    """Bit masks of the tables, as signed 64-bit values."""
    kinds = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, kinds + 1):
        mask = sum(1 << b for b in range(64) if bin((b % kinds + 1) & v).count("1") & 1)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``fp`` that connect exactly those a
    chain of links of at most ``radius`` (1 or 2) differing bits connects."""
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = covering_masks(radius)
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("mask")) for i, m in enumerate(masks)]))
    keyed = distinct.select("fp", table.alias("x")).select("fp", "x.t", "x.mask", F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"))
    sizes = keyed.groupBy("t", "key").count().filter("count > 1")
    shared = materialize(keyed.join(sizes, ["t", "key"]), "buckets")
    small = shared.filter(F.col("count") <= PAIRWISE)
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius
    pairs = (
        small.alias("a").join(small.alias("b"), (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & near)
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    )
    bits = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    big = shared.filter(F.col("count") > PAIRWISE)
    if radius == 2:  # the ball of radius one in the bits that the table's mask leaves free
        big = big.select("fp", "t", F.explode(bits).alias("bit"), "mask").filter("bit & mask = 0")
        ball = big.select("fp", "t", F.col("fp").bitwiseXOR(F.col("bit")).alias("point"))
        hub = ball.groupBy("t", "point").agg(F.min("fp").alias("b"), F.max("fp").alias("m")).filter("b < m")
        wide = ball.join(hub.drop("m"), ["t", "point"]).filter("fp > b").select(F.col("fp").alias("a"), "b")
    else:  # one free bit cleared: fingerprints that differ in that bit alone meet
        big = big.select("fp", "t", F.explode(bits).alias("bit"), "mask").filter("bit <> 0 and bit & mask = 0")
        ball = big.select("fp", "t", "bit", F.col("fp").bitwiseAND(F.bitwise_not("bit")).alias("point"))
        hub = ball.groupBy("t", "bit", "point").agg(F.min("fp").alias("b"), F.max("fp").alias("m")).filter("b < m")
        wide = ball.join(hub.drop("m"), ["t", "bit", "point"]).filter("fp > b").select(F.col("fp").alias("a"), "b")
    return pairs.union(wide)


def components_of(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) of distinct fingerprints (fp, low: the smallest doc_id that has it)."""
    roots = components(links(distinct.select("fp"), radius), "a", "b")
    grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    return materialize(grouped.join(lowest, "root").select("fp", "component_id"), "simhash-groups")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest doc_id reachable over links."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    found = components_of(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), radius)
    return prints.join(found, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the row with the smallest doc_id, of rows with that doc_id the one
    with the smallest hash of its text.  A row belongs to its own text's component, so rows of
    one doc_id with different texts are judged apart.  Rows without a doc_id can't be named by a component and stay."""
    named = docs.filter("doc_id is not null")
    prints = materialize(_with_fingerprint(named.select("doc_id", "text"), shingle), "fingerprints")
    groups = components_of(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), radius)
    # the smallest (doc_id, hash of the text) of each component, by aggregates with a map-side step
    least = prints.groupBy("fp").agg(F.min(F.struct("doc_id", "t")).alias("x")).join(groups, "fp")
    chosen = least.groupBy("component_id").agg(F.min("x").alias("x")).select("x.doc_id", "x.t")
    rows = named.select(whole_rows(named), F.col("doc_id"), F.xxhash64("text").alias("t"))
    one = rows.join(chosen, ["doc_id", "t"], "left_semi").dropDuplicates(["doc_id", "t"])
    return unpacked(one, docs.columns).unionByName(docs.filter("doc_id is null"))

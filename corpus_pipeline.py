"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in
the shared folder and read again as the next one's docs.  All but the last return the columns
of ``documents``.  No stage can be expressed in SQL (ORACLE_SQL is None); tests compare each
with a brute-force version.

Rows with null text pass the quality stage on its bias alone, are one SimHash group with the
empty texts, and give no tokens; an empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinelake.llm import classifier, latent, pieces, simhash, suffixes
from cinelake.llm.common import ship
from cinelake.session import materialize


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    return classifier.keep_good(docs, _read(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, at most two differing bits."""
    ship(spark)
    return simhash.keep_one(docs, shingle=3, radius=2)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of any 200-byte string that occurs again; no row goes."""
    ship(spark)
    return suffixes.without_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaked into."""
    ship(spark)
    return latent.decontaminate(docs, _read(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, lossless and the token ids, with seeded merge-dropout."""
    ship(spark)
    return pieces.tokenize(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding", as_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the whole ``documents`` table."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs

"""The operators bound to the driver's tables: one thin query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import align, bytebpe, chat, classifier, graphann, langid, latent, phrases, pieces, simhash, suffixes, toxicity, urltree
from cinelake.llm.common import ship


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(chat.with_control(_read(spark, sf_dir, "conversations")))


def op3_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.tokenize(_read(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_read(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphann.nearest(_read(spark, sf_dir, "embeddings"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judge(_read(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digests(_read(spark, sf_dir, "documents"))


def op12_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(_read(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_chat": op2_chat,
    "op3_latent": op3_latent,
    "op4_pieces": op4_pieces,
    "op5_quality": op5_quality,
    "op6_suffixes": op6_suffixes,
    "op7_neighbours": op7_neighbours,
    "op8_urls": op8_urls,
    "op9_language": op9_language,
    "op10_simhash": op10_simhash,
    "op11_align": op11_align,
    "op12_bytebpe": op12_bytebpe,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL: dict[str, str] = {"op2_chat": chat.ORACLE_SQL, "op8_urls": urltree.ORACLE_SQL, "op13_phrases": phrases.ORACLE_SQL}

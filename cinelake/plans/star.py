"""Refined star schema (Q5-Q10): one fact at film x artist x role grain and four
dimensions with stable surrogate keys.

Differences from the reference's job, all on purpose:
* ids come from ``surrogate_key`` over the natural key (W1), so the id written to a
  dimension equals the id joined into the fact in any plan and any partitioning;
  no driver round trip is needed to "freeze" them;
* a null release date never becomes a dimension row (it could never match) and a
  null date never gets the 'Q4' label;
* a film fetched on several dates has its newest record in the star, so no film is
  counted twice;
* the numbered dimensions and the fact are written once to the shared checkpoint folder,
  and everything later reads them;
* a build is written to a folder of its own and becomes the current one with its last step,
  so readers never see old and new ids mixed;
* the fact is partitioned by release year, spread by a rebalance, and can be catalogued
  bucketed on the film id for shuffle-free re-joins (``write_star_bucketed``).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.dates import quarter_label
from cinelake.functions.text import classify_tags, label_codes
from cinelake.operators.joins import inner_join, left_lookup, lookup_key
from cinelake.operators.keys import KeyRegistry
from cinelake.operators.quality import audit
from cinelake.operators.windows import surrogate_key
from cinelake.session import materialize, remove_path, run_concurrently
from cinelake.sources.sinks import write_fact


@dataclass(frozen=True)
class FilmColumns:
    """Column names of the trusted tables (defaults: the film catalogue's own)."""

    credit_id: str = "id"
    main_title: str = "tituloPrincipal"
    original_title: str = "tituloOriginal"
    tags: str = "genero"
    credit_rating: str = "notaMedia"
    credit_votes: str = "numeroVotos"
    role: str = "personagem"
    artist: str = "nomeArtista"
    details_id: str = "id"
    details_key: str = "imdb_id"
    release_date: str = "release_date"
    runtime: str = "runtime"
    revenue: str = "revenue"
    budget: str = "budget"
    popularity: str = "popularity"
    vote_average: str = "vote_average"
    vote_count: str = "vote_count"
    # fixed values: LIKE patterns of genre class A (code 1) and B (code 2)
    pattern_a: str = "%Fantasy%"
    pattern_b: str = "%Sci-Fi%"


# The fact's columns.
FACT_COLUMNS = [
    "id_movie", "id_genre", "id_date", "id_actor", "runtime", "revenue", "budget", "actor_role",
    "popularity", "imdb_rating", "tmdb_rating", "imdb_vote_count", "tmdb_vote_count",
]


@dataclass
class Star:
    dim_actor: DataFrame
    dim_date: DataFrame
    dim_movie: DataFrame
    fact: DataFrame
    dim_genre: DataFrame


def newest_details(details: DataFrame, c: FilmColumns = FilmColumns()) -> DataFrame:
    """One record per film: that of the newest ``extraction_date`` (records of one date that
    differ: the largest by the other columns, in order).  Details' own id becomes tmdb_id."""
    df = details.withColumnRenamed(c.details_id, "tmdb_id")
    key = c.details_key if c.details_key != c.details_id else "tmdb_id"
    if "extraction_date" not in df.columns:
        return df
    rest = [x for x in df.columns if x not in (key, "extraction_date")]
    newest = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct("extraction_date", *rest)).alias("__r"))
    return newest.select(*[F.col(key) if x == key else F.col("__r")[x].alias(x) for x in df.columns])


def joined_view(credits: DataFrame, details: DataFrame, c: FilmColumns = FilmColumns()) -> DataFrame:
    """J1 + F5: credits with their genre class, inner-joined on the external id to the
    newest record of each film (details' own id is kept as tmdb_id)."""
    left = credits.withColumn("id_genre", classify_tags(c.tags, c.pattern_a, c.pattern_b))
    key = c.details_key if c.details_key != c.details_id else "tmdb_id"
    return inner_join(left, newest_details(details, c), c.credit_id, key)


def _numbered(df: DataFrame, natural: str, keys: KeyRegistry | None) -> DataFrame:
    """Dimension rows with their ids: by rank of the natural key, or as a registry gave them out."""
    if keys is None:
        return surrogate_key(df, [natural], "id")
    df = materialize(df, "dimension")
    return df.join(keys.assign(df, [natural]), natural).select("id", *df.columns)


def dim_actor(trusted_credits: DataFrame, c: FilmColumns = FilmColumns(), keys: KeyRegistry | None = None) -> DataFrame:
    """Q5: one row per artist name with its credit-row count over all trusted
    credits (so it also holds artists the fact never references)."""
    counts = trusted_credits.groupBy(F.col(c.artist).alias("name")).agg(F.count(F.lit(1)).alias("num_movies"))
    return _numbered(counts, "name", keys)


def dim_date(trusted_details: DataFrame, c: FilmColumns = FilmColumns(), keys: KeyRegistry | None = None) -> DataFrame:
    """Q6: distinct non-null release dates with parts and quarter, id by date."""
    dates = trusted_details.select(F.col(c.release_date).alias("date")).where(F.col("date").isNotNull()).distinct()
    dates = dates.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        quarter_label("date").alias("quarter"),
    )
    return _numbered(dates, "date", keys)


def dim_movie(credits: DataFrame, details: DataFrame, c: FilmColumns = FilmColumns()) -> DataFrame:
    """Q7: distinct film attributes of the films on both sides.  The credits are reduced
    to films before the join."""
    films = credits.select(
        F.col(c.credit_id).alias("id"),
        F.col(c.main_title).alias("main_title"),
        F.col(c.original_title).alias("original_title"),
        F.col(c.tags).alias("genres"),
    ).distinct()
    key = c.details_key if c.details_key != c.details_id else "tmdb_id"
    dates = newest_details(details, c).select(F.col(key).alias("__film"), F.col(c.release_date).alias("release_date"))
    joined = films.join(dates, F.col("id") == F.col("__film")).distinct()
    return joined.select("id", "main_title", "original_title", "release_date", "genres")


def fact_rows(joined: DataFrame, c: FilmColumns = FilmColumns()) -> DataFrame:
    """Distinct fact projection of the joined view, natural keys still in place."""
    return joined.select(
        F.col(c.credit_id).alias("id_movie"),
        F.col(c.artist).alias("artist_name"),
        F.col(c.release_date).alias("release_date"),
        "id_genre",
        F.col(c.runtime).alias("runtime"),
        F.col(c.revenue).alias("revenue"),
        F.col(c.budget).alias("budget"),
        F.col(c.role).alias("actor_role"),
        F.col(c.popularity).alias("popularity"),
        F.col(c.credit_rating).alias("imdb_rating"),
        F.col(c.vote_average).alias("tmdb_rating"),
        F.col(c.credit_votes).alias("imdb_vote_count"),
        F.col(c.vote_count).alias("tmdb_vote_count"),
    ).distinct()


def fact_movie_actor(joined: DataFrame, dates: DataFrame, actors: DataFrame, c: FilmColumns = FilmColumns()) -> DataFrame:
    """Q8: distinct fact rows, date key (inner: null dates drop), artist key (inner on
    name), helper columns dropped, keys first.  The grain includes the role, so one
    artist with two roles in a film gives two rows (reported by pk_violations)."""
    rows = fact_rows(joined, c)
    rows = lookup_key(rows, dates, "release_date", "date", "id", "id_date")
    rows = lookup_key(rows, actors, "artist_name", "name", "id", "id_actor")
    return rows.select(*FACT_COLUMNS)


def dim_genre(fact: DataFrame) -> DataFrame:
    """Q9: distinct films per genre class, labelled."""
    counts = fact.groupBy(F.col("id_genre").alias("id")).agg(F.count_distinct("id_movie").alias("num_movies"))
    return counts.select("id", label_codes("id").alias("genre"), "num_movies")


@dataclass
class StarInputs:
    """What the fact and dimensions are built from: the trusted tables, their join, and the
    numbered artist and date dimensions."""

    credits: DataFrame
    details: DataFrame
    joined: DataFrame
    actors: DataFrame
    dates: DataFrame


def prepare_star(
    trusted_credits: DataFrame,
    trusted_details: DataFrame,
    c: FilmColumns = FilmColumns(),
    materialize_inputs: bool = True,
    keys: str | None = None,
) -> StarInputs:
    """``keys`` names a folder of key registries: artists and dates then keep their ids over builds.
    ``materialize_inputs`` writes the two trusted inputs once as Parquet to the shared
    checkpoint folder, so that numbering the dimensions and building the fact read them,
    pruned to the columns each step needs, instead of re-running the raw-to-trusted lineage
    per pass.  Where the trusted layer is on disk already, pass False."""
    if materialize_inputs:
        trusted_credits, trusted_details = run_concurrently(
            (materialize, trusted_credits, "trusted-credits"), (materialize, trusted_details, "trusted-details")
        )
    spark = trusted_credits.sparkSession
    known = [KeyRegistry(spark, f"{keys.rstrip('/')}/{n}") if keys else None for n in ("actors", "dates")]
    actors, dates = run_concurrently((dim_actor, trusted_credits, c, known[0]), (dim_date, trusted_details, c, known[1]))
    return StarInputs(trusted_credits, trusted_details, joined_view(trusted_credits, trusted_details, c), actors, dates)


def build_star(
    trusted_credits: DataFrame,
    trusted_details: DataFrame,
    c: FilmColumns = FilmColumns(),
    materialize_inputs: bool = True,
    keys: str | None = None,
) -> Star:
    """All five tables.  The fact is written once and read by whatever comes after it."""
    p = prepare_star(trusted_credits, trusted_details, c, materialize_inputs, keys)
    fact = materialize(fact_movie_actor(p.joined, p.dates, p.actors, c), "fact")
    return Star(p.actors, p.dates, dim_movie(p.credits, p.details, c), fact, dim_genre(fact))


def star_flatten(star: Star) -> DataFrame:
    """Q10: fact left-joined to the four dimensions (the analysis table).  Both the
    genre and the artist dimension carry num_movies; they are named apart."""
    genre = star.dim_genre.withColumnRenamed("num_movies", "genre_num_movies")
    actor = star.dim_actor.withColumnRenamed("num_movies", "actor_num_movies")
    out = left_lookup(star.fact, star.dim_movie, "id_movie", "id")
    out = left_lookup(out, star.dim_date, "id_date", "id")
    out = left_lookup(out, genre, "id_genre", "id")
    return left_lookup(out, actor, "id_actor", "id")


class AuditFailed(ValueError):
    """A build whose audit found violations; it is written, but not the current one."""

    def __init__(self, folder: str, found: list[str]):
        super().__init__(f"{folder} is not published: " + "; ".join(found))
        self.folder, self.found = folder, found


# The fact's declared key and NOT NULL columns.
DECLARED_KEY = ["id_movie", "id_actor", "id_date", "id_genre"]
FACT_NOT_NULL = ["id_movie", "id_genre", "id_date", "id_actor", "runtime", "revenue", "budget"]


def audit_star(s: Star) -> DataFrame:
    """V3-V5 of a star's fact, in one pass over it.  Its key is the declared one and the role, as one
    artist may have several roles in a film; groups of the declared key alone are reported."""
    refs = [("id_movie", s.dim_movie, "id"), ("id_actor", s.dim_actor, "id"), ("id_date", s.dim_date, "id"), ("id_genre", s.dim_genre, "id")]
    return audit(s.fact, FACT_NOT_NULL, refs, [*DECLARED_KEY, "actor_role", "imdb_rating", "imdb_vote_count"], DECLARED_KEY)


def write_star(star: Star, root: str, gate: bool = True) -> str:
    """Write the dimensions and the fact, partitioned by release year, to a build
    folder of their own under ``root``; audit what was written, with the findings in the folder's ``audit``; the last
    step makes it the current build.  With ``gate`` a build with violations that block is not made
    current (``AuditFailed``).  Returns the build's folder.  Older builds stay until ``drop_old_builds``."""
    spark = star.fact.sparkSession
    root = root.rstrip("/")
    build = f"build-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/{build}"
    for name in ("dim_actor", "dim_date", "dim_movie", "dim_genre"):
        getattr(star, name).write.parquet(f"{folder}/{name}")
    years = star.dim_date.select(F.col("id").alias("__d"), F.col("year").alias("release_year"))
    fact = star.fact.join(years, F.col("id_date") == F.col("__d"), "left").drop("__d")
    write_fact(fact, f"{folder}/fact_movie_actor")
    if gate:
        audit_star(_read_build(spark, folder)).write.parquet(f"{folder}/audit")
        bad = spark.read.parquet(f"{folder}/audit").filter("blocks and n_violations > 0").orderBy("check_name", "what").collect()
        if bad:
            raise AuditFailed(folder, [f"{r.check_name} {r.what}: {r.n_violations}" for r in bad])
    # one appended row: readers see the build before or after it, never a part
    spark.createDataFrame([(build,)], "build string").coalesce(1).write.mode("append").json(f"{root}/builds")
    return folder


def current_build(spark, root: str) -> str:
    """Folder of the newest complete build under ``root``."""
    root = root.rstrip("/")
    return f"{root}/" + spark.read.schema("build string").json(f"{root}/builds").agg(F.max("build")).first()[0]


def drop_old_builds(spark, root: str) -> None:
    """Delete every published build under ``root`` but the current one.  Builds that were never published
    stay: one may still be written, another may be looked at for its audit."""
    root = root.rstrip("/")
    builds = [r.build for r in spark.read.schema("build string").json(f"{root}/builds").distinct().collect()]
    for name in sorted(builds)[:-1]:
        remove_path(spark, f"{root}/{name}")


def read_star(spark, root: str) -> Star:
    return _read_build(spark, current_build(spark, root))


def _read_build(spark, folder: str) -> Star:
    r = spark.read.parquet
    fact = r(f"{folder}/fact_movie_actor").drop("release_year")
    return Star(r(f"{folder}/dim_actor"), r(f"{folder}/dim_date"), r(f"{folder}/dim_movie"), fact, r(f"{folder}/dim_genre"))


def write_star_bucketed(star: Star, root: str, prefix: str = "refined_", n_buckets: int = 64) -> dict[str, str]:
    """S6 / S7 / S14 for repeated analysis: the refined tables as catalogue tables
    (external, under ``root``) with the fact and the film dimension bucketed and
    sorted on the film id in the same number of buckets.  Joins of the two then run
    without a shuffle on either side; the small dimensions are broadcast anyway.
    Size ``n_buckets`` so one bucket of the fact is a few hundred MB."""
    root = root.rstrip("/")
    tables = {}
    plan = [
        ("fact_movie_actor", star.fact, "id_movie"),
        ("dim_movie", star.dim_movie, "id"),
        ("dim_actor", star.dim_actor, None),
        ("dim_date", star.dim_date, None),
        ("dim_genre", star.dim_genre, None),
    ]
    for name, df, key in plan:
        table = f"{prefix}{name}"
        writer = df.write.mode("overwrite").option("path", f"{root}/{name}")
        if key:
            writer = writer.bucketBy(n_buckets, key).sortBy(key)
        writer.saveAsTable(table)
        tables[name] = table
    return tables

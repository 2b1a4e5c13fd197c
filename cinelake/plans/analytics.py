"""Analyses on the star (Q11-Q21).

Grain rule: the fact repeats film measures once per artist and role, so every film
measure is reduced to distinct films (films and genres, or artists and films) before it is
summed or averaged.  ``fit`` functions report both grains: the fact grain (what the
reference's notebook computed) and the film grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.text import label_codes
from cinelake.operators.aggregates import fit_line
from cinelake.operators.windows import share_of_total, top_n_per_group
from cinelake.plans.star import Star

FILM_MEASURES = ["runtime", "revenue", "budget", "popularity", "tmdb_rating", "tmdb_vote_count"]
DIGITS = 6


def _dated(star: Star, films: DataFrame) -> DataFrame:
    """Films with the year and quarter of their release; dim_date is a bounded calendar."""
    dates = star.dim_date.select(F.col("id").alias("__d"), "year", "quarter")
    return films.join(dates, F.col("id_date") == F.col("__d"), "left").drop("__d")


def film_grain(star: Star) -> DataFrame:
    """One row per film: film-level measures, release year and quarter.  A film whose credits
    carry several tag strings, and so several genre classes, is one film."""
    return _dated(star, star.fact.select("id_movie", "id_date", *FILM_MEASURES).distinct())


def film_genre_grain(star: Star) -> DataFrame:
    """One row per film and genre class, with the class's label."""
    films = star.fact.select("id_movie", "id_genre", "id_date", *FILM_MEASURES).distinct()
    return _dated(star, films).withColumn("genre", label_codes("id_genre"))


def releases_per_year(star: Star) -> DataFrame:
    """Q11: distinct films released per year."""
    return film_grain(star).groupBy("year").agg(F.count(F.lit(1)).alias("releases"))


def popularity_per_year(star: Star) -> DataFrame:
    """Q12: releases and mean film popularity per year."""
    return film_grain(star).groupBy("year").agg(
        F.count(F.lit(1)).alias("releases"),
        F.round(F.avg("popularity"), DIGITS).alias("avg_popularity"),
    )


def budget_revenue_per_year(star: Star, year_from: int, year_to: int) -> DataFrame:
    """Q13: film-grain budget and revenue per year inside [year_from, year_to]."""
    films = film_grain(star).filter(F.col("year").between(year_from, year_to))
    return films.groupBy("year").agg(
        F.count(F.lit(1)).alias("releases"),
        F.sum("budget").alias("total_budget"),
        F.sum("revenue").alias("total_revenue"),
        F.round(F.avg("budget"), DIGITS).alias("avg_budget"),
        F.round(F.avg("revenue"), DIGITS).alias("avg_revenue"),
    )


def _two_grains(star: Star, x: str, y: str, extra=()) -> DataFrame:
    fact = fit_line(star.fact, x, y, extra=extra).select(F.lit("fact").alias("grain"), "*")
    films = fit_line(film_grain(star), x, y, extra=extra).select(F.lit("film").alias("grain"), "*")
    return fact.unionByName(films)


def budget_revenue_fit(star: Star) -> DataFrame:
    """Q14: correlation and least-squares line of revenue on budget."""
    return _two_grains(star, "budget", "revenue")


def rating_popularity_fit(star: Star) -> DataFrame:
    """Q15: popularity on audience rating, with the mean budget as a third measure
    (one aggregate per grain; budgets are never null in the star)."""
    return _two_grains(star, "tmdb_rating", "popularity", [F.round(F.avg("budget"), DIGITS).alias("avg_budget")])


def seasonal_share(star: Star, digits: int = 2) -> DataFrame:
    """Q16: revenue per genre x quarter and its percent of the genre's revenue.
    The window runs over the aggregated rows (at most 3 x 4), never over raw rows."""
    sums = (
        film_genre_grain(star)
        .filter(F.col("quarter").isNotNull())
        .groupBy("genre", "quarter")
        .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("films"))
    )
    return share_of_total(sums, "revenue", ["genre"], "share_pct", digits)


def _artist_films(star: Star) -> DataFrame:
    pairs = star.fact.select("id_actor", "id_movie", "popularity", "revenue").distinct()
    names = star.dim_actor.select(F.col("id").alias("__a"), F.col("name"))
    return pairs.join(names, F.col("id_actor") == F.col("__a"), "inner").drop("__a")


def top_artists_popularity(star: Star, k: int = 10) -> DataFrame:
    """Q17: most recurring artists (distinct films) with their mean film popularity."""
    per_artist = _artist_films(star).groupBy("id_actor", "name").agg(
        F.count(F.lit(1)).alias("films"), F.round(F.avg("popularity"), DIGITS).alias("avg_popularity")
    )
    return per_artist.orderBy(F.col("films").desc(), F.col("avg_popularity").desc(), F.col("name").asc()).limit(k)


def top_artists_revenue(star: Star, k: int = 10) -> DataFrame:
    """Q18: artists by accumulated revenue over their distinct films."""
    per_artist = _artist_films(star).groupBy("id_actor", "name").agg(
        F.count(F.lit(1)).alias("films"), F.sum("revenue").alias("total_revenue")
    )
    return per_artist.orderBy(F.col("total_revenue").desc(), F.col("name").asc()).limit(k)


def artist_recurrence(star: Star) -> DataFrame:
    """Q19: for every artist, films of the artist / all films (scalar subquery for
    the total, no driver round trip)."""
    total = star.fact.agg(F.count_distinct("id_movie")).scalar()
    per_artist = star.fact.select("id_actor", "id_movie").distinct().groupBy("id_actor").agg(
        F.count(F.lit(1)).alias("films")
    )
    return per_artist.withColumn("recurrence", F.round(F.col("films") / total, DIGITS))


def rating_by_genre(star: Star) -> DataFrame:
    """Q20: mean audience rating per genre class over distinct films."""
    return film_genre_grain(star).groupBy("genre").agg(
        F.count(F.lit(1)).alias("films"),
        F.round(F.avg("tmdb_rating"), DIGITS).alias("avg_rating"),
    )


def top_popular_per_genre(star: Star, n: int = 10) -> DataFrame:
    """Q21: the n most popular films of each genre class (ties by film id)."""
    films = film_genre_grain(star).select("genre", "id_movie", "popularity")
    return top_n_per_group(films, ["genre"], ["popularity", "id_movie"], n, descending=True, rank_col="rank")

"""Fixed schemas of the raw, trusted and refined tables.

Raw JSON is read with a fixed schema too: streaming reads need one, and an inferred
type that drifts between batches (long in one file, double in another) would break
the union of batches.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw credits, pipe-separated text; columns bind by position (header skipped).
# Column names as the source files name them ('tituloPincipal' sic).
RAW_CREDITS_DDL = (
    "id STRING, tituloPincipal STRING, tituloOriginal STRING, anoLancamento INT, "
    "tempoMinutos INT, genero STRING, notaMedia DOUBLE, numeroVotos INT, "
    "generoArtista STRING, personagem STRING, nomeArtista STRING, anoNascimento INT, "
    "anoFalecimento INT, profissao STRING, titulosMaisConhecidos STRING"
)

# Artist columns the trusted layer does not keep, and the title fix.
CREDIT_COLUMNS_DROPPED = ["generoArtista", "anoNascimento", "anoFalecimento", "profissao", "titulosMaisConhecidos"]
CREDIT_RENAMES = {"tituloPincipal": "tituloPrincipal"}

GENRE_STRUCT = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])

# Raw details, JSON lines; the 11 keys kept from each web reply, in order.
RAW_DETAILS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("imdb_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("vote_average", T.DoubleType()),
        T.StructField("vote_count", T.LongType()),
        T.StructField("popularity", T.DoubleType()),
        T.StructField("budget", T.LongType()),
        T.StructField("revenue", T.LongType()),
        T.StructField("runtime", T.LongType()),
        T.StructField("genres", T.ArrayType(GENRE_STRUCT)),
    ]
)
DETAIL_KEYS = [f.name for f in RAW_DETAILS_SCHEMA.fields]

# Trusted tables as the trusted jobs write them (the refined job checks these, V6).
TRUSTED_CREDITS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("tituloPrincipal", T.StringType()),
        T.StructField("tituloOriginal", T.StringType()),
        T.StructField("anoLancamento", T.IntegerType()),
        T.StructField("tempoMinutos", T.IntegerType()),
        T.StructField("genero", T.StringType()),
        T.StructField("notaMedia", T.DoubleType()),
        T.StructField("numeroVotos", T.IntegerType()),
        T.StructField("personagem", T.StringType()),
        T.StructField("nomeArtista", T.StringType()),
    ]
)
TRUSTED_DETAILS_SCHEMA = T.StructType(
    [f for f in RAW_DETAILS_SCHEMA.fields if f.name not in ("genres", "release_date")]
    + [T.StructField("release_date", T.DateType()), T.StructField("extraction_date", T.DateType())]
)

DIM_GENRE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("genre", T.StringType()),
        T.StructField("num_movies", T.LongType()),
    ]
)
DIM_DATE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("quarter", T.StringType()),
    ]
)
DIM_ACTOR_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("num_movies", T.LongType())]
)

# Declared keys of the dimensional model (enforced by checks, not by the files).
STAR_PRIMARY_KEYS = {
    "dim_genre": ["id"],
    "dim_date": ["id"],
    "dim_movie": ["id"],
    "dim_actor": ["id"],
    "fact_movie_actor": ["id_movie", "id_actor", "id_date", "id_genre"],
}
STAR_NOT_NULL = {
    "dim_genre": ["genre"],
    "dim_date": ["date", "year", "month", "day", "quarter"],
    "dim_movie": ["main_title", "original_title", "release_date", "genres"],
    "dim_actor": ["name"],
    "fact_movie_actor": [
        "runtime", "revenue", "budget", "popularity", "imdb_rating", "tmdb_rating",
        "imdb_vote_count", "tmdb_vote_count",
    ],
}

"""Trusted layer (Q1-Q3): raw credits and raw details cleaned into typed tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.functions.dates import date_from_path, parse_date
from cinelake.operators.filters import (
    dropna_any,
    filter_like_any,
    filter_min,
    filter_nonzero,
    filter_tag_token,
    replace_sentinel,
)
from cinelake.operators.projection import drop_columns, rename_columns
from cinelake.operators.sets import distinct_values, drop_duplicates
from cinelake.sources.schemas import CREDIT_COLUMNS_DROPPED, CREDIT_RENAMES

# The two genre tags the catalogue keeps, and the vote minimum.
DEFAULT_TAG_PATTERNS = ("%Sci-Fi%", "%Fantasy%")
DEFAULT_TAG_TOKENS = ("Sci-Fi", "Fantasy")
MIN_VOTES = 30
NULL_SENTINEL = "\\N"


def trusted_credits(
    raw: DataFrame,
    tag_col: str = "genero",
    tag_patterns: Sequence[str] = DEFAULT_TAG_PATTERNS,
    drop_cols: Sequence[str] = CREDIT_COLUMNS_DROPPED,
    renames: Mapping[str, str] = CREDIT_RENAMES,
    role_col: str = "personagem",
    sentinel: str = NULL_SENTINEL,
    votes_col: str = "numeroVotos",
    min_votes: int = MIN_VOTES,
    counted: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> DataFrame:
    """Q1: drop artist columns, fix the title name, keep the wanted tags (substring),
    de-duplicate whole rows, drop rows with any null, turn the role sentinel into
    null (after dropna, so those rows stay), keep rows with enough votes.

    Catalyst pushes the tag and vote filters below the de-duplication aggregate and
    into the scan; the de-dup is one hash aggregate with a map-side partial step.  ``counted``
    (a ``Funnel``) sees every stage (V1)."""
    df = drop_columns(counted("raw", raw), drop_cols)
    df = rename_columns(df, renames)
    df = counted("tag_filter", filter_like_any(df, tag_col, tag_patterns))
    df = drop_duplicates(df)
    df = counted("dedup_dropna", dropna_any(df))
    df = replace_sentinel(df, role_col, sentinel)
    return counted("min_votes", filter_min(df, votes_col, min_votes))


def trusted_details(
    raw: DataFrame,
    nonzero_cols: Sequence[str] = ("revenue", "budget", "runtime"),
    votes_col: str = "vote_count",
    min_votes: int = MIN_VOTES,
    date_col: str = "release_date",
    drop_cols: Sequence[str] = ("genres",),
    extraction_date: dt.date | None = None,
    path_col: str | Column | None = None,
    stamp: bool = True,
    counted: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> DataFrame:
    """Q2: de-duplicate whole records (before the genre array is dropped, so records
    that differ only in genres both survive), parse the release date (empty text gives
    null), drop zero-or-null measures, keep enough votes, stamp the extraction date:
    a literal, or per row from the yyyy/MM/dd folder of ``path_col`` (F7); without
    ``stamp`` the raw rows carry it already."""
    if path_col is not None:
        path = F.col(path_col) if isinstance(path_col, str) else path_col
        raw = raw.withColumn("extraction_date", date_from_path(path))
    df = counted("dedup", drop_duplicates(counted("raw", raw)))
    df = drop_columns(df, drop_cols)
    df = df.withColumn(date_col, parse_date(date_col))
    df = counted("nonzero", filter_nonzero(df, nonzero_cols))
    df = counted("min_votes", filter_min(df, votes_col, min_votes))
    if path_col is None and stamp:
        df = df.withColumn("extraction_date", F.lit(extraction_date).cast("date"))
    return df


def candidate_ids(
    raw: DataFrame, id_col: str = "id", tag_col: str = "genero", tags: Sequence[str] = DEFAULT_TAG_TOKENS, sep: str = ","
) -> DataFrame:
    """Q3: distinct ids whose tag list holds one of the exact tokens."""
    return distinct_values(filter_tag_token(raw, tag_col, tags, sep), id_col)

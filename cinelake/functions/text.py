"""Tag, label and path expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def like_any(c: ColumnOrName, patterns: Sequence[str]) -> Column:
    """P5: SQL LIKE against any of the patterns (case-sensitive; null never matches).
    Catalyst turns '%x%' into Contains and pushes it to the scan as StringContains."""
    col = _c(c)
    out = F.lit(False)
    for i, p in enumerate(patterns):
        cond = col.like(p)
        out = cond if i == 0 else (out | cond)
    return out


def split_tags(c: ColumnOrName, sep: str = ",") -> Column:
    """split a delimited tag string into an array (literal separator)."""
    return F.split(_c(c), re.escape(sep))


def has_any_tag(c: ColumnOrName, tags: Sequence[str], sep: str = ",") -> Column:
    """Exact-token membership, unlike like_any: 'Science Fantasyland' does not
    hold the token 'Fantasy'.  Null tag strings give null (row dropped by filter)."""
    return F.arrays_overlap(split_tags(c, sep), F.array(*[F.lit(t) for t in tags]))


def sentinel_to_null(c: ColumnOrName, sentinel: str = "\\N") -> Column:
    """P10: a sentinel text becomes null; every other value is kept."""
    return F.nullif(_c(c), F.lit(sentinel))


def classify_tags(c: ColumnOrName, pattern_a: str, pattern_b: str) -> Column:
    """1 = only A, 2 = only B, 3 = both, else null (substring LIKE semantics)."""
    col = _c(c)
    a = col.like(pattern_a)
    b = col.like(pattern_b)
    return (
        F.when(a & ~b, F.lit(1))
        .when(b & ~a, F.lit(2))
        .when(a & b, F.lit(3))
        .otherwise(F.lit(None).cast("int"))
    )


# Genre class code to label, as the refined genre dimension writes them.
GENRE_LABELS = {1: "Fantasy", 2: "Sci-Fi", 3: "Fantasy/Sci-Fi"}


def label_codes(c: ColumnOrName, labels: dict[int, str] | None = None) -> Column:
    """code to label through a literal map; unknown codes give null."""
    labels = GENRE_LABELS if labels is None else labels
    col = _c(c)
    out = None
    for code, label in labels.items():
        out = (F.when if out is None else out.when)(col == F.lit(code), F.lit(label))
    return out if out is not None else F.lit(None).cast("string")


def path_basename(c: ColumnOrName) -> Column:
    """last '/' segment of a path."""
    return F.substring_index(_c(c), "/", -1)


def dataset_name(c: ColumnOrName) -> Column:
    """base name without extension, first letter upper and the rest lower
    ('Filmes E Series.csv' -> 'Filmes e series'; not initcap)."""
    base = path_basename(c)
    stem = F.regexp_replace(base, r"\.[^.]*$", "")
    return F.concat(F.upper(F.substring(stem, 1, 1)), F.lower(F.substring(stem, 2, 1 << 30)))


def landing_path(
    layer: ColumnOrName,
    origin: ColumnOrName,
    fmt: ColumnOrName,
    dataset: ColumnOrName,
    day: ColumnOrName,
    file_name: ColumnOrName,
) -> Column:
    """layer/origin/format/dataset/yyyy/MM/dd/file."""
    return F.concat_ws(
        "/", _c(layer), _c(origin), _c(fmt), _c(dataset), F.date_format(_c(day), "yyyy/MM/dd"), _c(file_name)
    )


def scale_units(c: ColumnOrName) -> dict[str, Column]:
    """display scaling of money: whole millions and billions to one decimal."""
    col = _c(c).cast("double")
    return {"millions": F.round(col / 1e6, 0), "billions": F.round(col / 1e9, 1)}

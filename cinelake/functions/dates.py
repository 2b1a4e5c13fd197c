"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """text to date; empty or malformed text gives null instead of an ANSI error."""
    return F.try_to_date(_c(c), fmt)


def date_parts(c: ColumnOrName) -> dict[str, Column]:
    """year, month and day of month of a date."""
    d = _c(c)
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def quarter_label(c: ColumnOrName) -> Column:
    """'Q1'..'Q4'; a null date stays null (never defaults to Q4)."""
    return F.concat(F.lit("Q"), F.quarter(_c(c)).cast("string"))


# Date folder at the end of a landing path: .../yyyy/MM/dd[/file]
_PATH_DATE = r"(\d{4})/(\d{2})/(\d{2})(?:/[^/]*)?/?$"


def date_from_path(path: ColumnOrName) -> Column:
    """date from the yyyy/MM/dd tail of a path, with or without trailing slash or
    file name.  Works per row, so one scan of many dated folders gets per-file dates
    (use ``F.col('_metadata.file_path')``)."""
    p = _c(path)
    text = F.concat_ws(
        "-",
        F.regexp_extract(p, _PATH_DATE, 1),
        F.regexp_extract(p, _PATH_DATE, 2),
        F.regexp_extract(p, _PATH_DATE, 3),
    )
    # no match gives "--", which try_to_date turns into null
    return F.try_to_date(text, "yyyy-MM-dd")


def date_to_path(c: ColumnOrName) -> Column:
    """F8: date to the 'yyyy/MM/dd' path part."""
    return F.date_format(_c(c), "yyyy/MM/dd")

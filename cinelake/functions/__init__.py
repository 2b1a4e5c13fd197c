"""Column expressions built only from Spark built-ins (no Python UDFs)."""

from cinelake.functions.dates import date_from_path, date_parts, date_to_path, parse_date, quarter_label
from cinelake.functions.json import event_object_location, event_records, project_json_keys
from cinelake.functions.text import (
    GENRE_LABELS,
    classify_tags,
    dataset_name,
    has_any_tag,
    label_codes,
    landing_path,
    like_any,
    path_basename,
    scale_units,
    sentinel_to_null,
    split_tags,
)

__all__ = [
    "GENRE_LABELS",
    "classify_tags",
    "dataset_name",
    "date_from_path",
    "date_parts",
    "date_to_path",
    "event_object_location",
    "event_records",
    "has_any_tag",
    "label_codes",
    "landing_path",
    "like_any",
    "parse_date",
    "path_basename",
    "project_json_keys",
    "quarter_label",
    "scale_units",
    "sentinel_to_null",
    "split_tags",
]

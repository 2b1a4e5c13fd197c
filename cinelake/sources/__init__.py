"""Readers, sinks and fixed schemas."""

from cinelake.sources.readers import landing_inventory, read_checked, read_delimited, read_json_lines, read_parquet
from cinelake.sources.schemas import (
    CREDIT_COLUMNS_DROPPED,
    CREDIT_RENAMES,
    DETAIL_KEYS,
    RAW_CREDITS_DDL,
    RAW_DETAILS_SCHEMA,
    STAR_NOT_NULL,
    STAR_PRIMARY_KEYS,
)
from cinelake.sources.sinks import (
    drop_unshown,
    land_once,
    publish_views,
    register_tables,
    write_fact,
    write_id_list,
    write_json_balanced,
    write_json_capped,
    write_parquet,
)

__all__ = [name for name in dir() if not name.startswith("_")]

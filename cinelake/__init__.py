"""cinelake: film-catalogue lake analytics as plain Spark DataFrame / SQL jobs.

Layers:
  sources/    readers, sinks, landing helpers (CSV, JSON lines, Parquet, file inventory)
  functions/  column expressions (dates, tags, paths, JSON)
  operators/  DataFrame -> DataFrame steps (projection, filters, joins, aggregates,
              windows, sorts, set ops, data-quality checks)
  plans/      composed jobs: trusted layer, enrichment, star schema, analyses
  streaming/  incremental file ingest and cross-batch de-duplication

Every operator takes DataFrames plus column names and returns a DataFrame; actions
only happen in sinks, streams, and in bounded driver-side steps that are documented
where they occur (boundary sampling for surrogate keys, size checks before broadcast).
"""

from cinelake.session import build_session, materialize, shared_dir, sizing_conf

__all__ = ["build_session", "materialize", "shared_dir", "sizing_conf"]

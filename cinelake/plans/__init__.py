"""Composed jobs: trusted layer, enrichment bookkeeping, star schema, analyses."""

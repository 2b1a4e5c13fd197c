"""Structured Streaming jobs: incremental ingest, idempotent batches, cross-batch de-dup."""

from cinelake.streaming.enrichment import enrichment_figures, stream_enrichment
from cinelake.streaming.ingest import (
    idempotent_partition_writer,
    stream_dedup,
    stream_ingest,
    stream_trusted_details,
    stream_with_batches,
)
from cinelake.streaming.landing import LandingTarget

__all__ = [
    "LandingTarget",
    "enrichment_figures",
    "idempotent_partition_writer",
    "stream_dedup",
    "stream_enrichment",
    "stream_ingest",
    "stream_trusted_details",
    "stream_with_batches",
]

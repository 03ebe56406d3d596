"""Earthquake feed ingestion and analysis as Spark jobs."""

from tremorline.operators import (
    CleanOptions,
    flat_events,
    nested_events,
    string_events,
    subsecond_events,
)
from tremorline.plans import IngestReport, analyse, ingest, show_answers, write_answers
from tremorline.sources import Run, read_table
from tremorline.streaming import ingest_new_documents

__all__ = [
    "CleanOptions",
    "IngestReport",
    "Run",
    "analyse",
    "flat_events",
    "ingest",
    "ingest_new_documents",
    "nested_events",
    "read_table",
    "show_answers",
    "string_events",
    "subsecond_events",
    "write_answers",
]

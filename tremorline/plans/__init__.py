from tremorline.plans.analysis import analyse, show_answers, write_answers
from tremorline.plans.ingestion import IngestReport, ingest

__all__ = ["IngestReport", "analyse", "ingest", "show_answers", "write_answers"]

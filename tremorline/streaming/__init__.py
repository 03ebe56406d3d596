from tremorline.streaming.incremental import ingest_new_documents

__all__ = ["ingest_new_documents"]

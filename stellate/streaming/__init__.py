from stellate.streaming.landing import ingest_new_files

__all__ = ["ingest_new_files"]

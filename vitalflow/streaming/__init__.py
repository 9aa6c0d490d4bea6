from .ingest import start_ingest, start_window_counts  # noqa: F401

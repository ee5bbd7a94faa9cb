from .incremental import enrich_stream  # noqa: F401

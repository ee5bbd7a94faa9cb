from .readers import scan_facts, scan_multipart, scan_wide_snapshots, scan_wide_years  # noqa: F401
from .writers import sink_csv, sink_metrics, sink_parquet  # noqa: F401

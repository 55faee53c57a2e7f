"""The same plans fed by arriving files."""

from labweave.streaming.ingest import rolling_error_rate, start_ingest

__all__ = ["rolling_error_rate", "start_ingest"]

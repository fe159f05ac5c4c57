"""Fitted models applied to streaming DataFrames."""

from .apply import apply_stages, run_available, stream_files  # noqa: F401
from .incremental import IncrementalFit  # noqa: F401

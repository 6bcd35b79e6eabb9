"""Streaming. The reference has no streams; the one place a stream fits is running the
partitioned load (L1) over staging files as they arrive, exactly once per file."""

from salesflow.streaming.incremental import read_incremental_output, run_incremental_load, start_incremental_load

__all__ = ["read_incremental_output", "run_incremental_load", "start_incremental_load"]

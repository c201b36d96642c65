"""Quality counters over a streaming source.

The reference is batch-only; this package only lets the same operators run
incrementally over files arriving in a folder (Structured Streaming), e.g. to
watch the stage-event export as it lands.
"""

from stagewise.streaming.monitor import interval_counts_stream, run_available

__all__ = ["interval_counts_stream", "run_available"]

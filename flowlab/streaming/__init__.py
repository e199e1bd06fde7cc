"""Streaming forms of the operators (Structured Streaming), their state
steps, and the runner that executes, restarts and reads back streams."""

from flowlab.streaming.operators import (PANDAS_STATE, TRANSFORM_WITH_STATE, batched_sink_stream,
                                         count_trigger_stream, count_window_stream, exclude_per_batch,
                                         exclude_stream, processing_time, read_state, rolling_stream,
                                         session_agg_stream, window_agg_stream, with_event_time)
from flowlab.streaming.runner import (StreamRun, read_back, run_to_completion, run_with_restarts, scoped_conf,
                                      start_stream, versioned_writer)

__all__ = ["PANDAS_STATE", "TRANSFORM_WITH_STATE", "batched_sink_stream", "count_trigger_stream",
           "count_window_stream", "exclude_per_batch", "exclude_stream", "processing_time", "read_state",
           "rolling_stream", "session_agg_stream", "window_agg_stream", "with_event_time", "StreamRun",
           "read_back", "run_to_completion", "run_with_restarts", "scoped_conf", "start_stream",
           "versioned_writer"]

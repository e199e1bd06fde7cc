"""flowlab: batch and streaming dataflow operators on Spark DataFrames."""

from flowlab.session import get_session, ensure_checkpoint_dir, scratch_path

__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path"]

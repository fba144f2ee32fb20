"""Batch and live-reading analytics for place-based data, expressed as PySpark DataFrames."""

from placewell.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

"""docflow - document processing on Spark DataFrames and Structured Streaming."""

from docflow.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

"""Larkspur: everyday analytics on large tables, expressed as Spark DataFrames."""

from larkspur.session import build_session, checkpointed, scratch_path

__all__ = ["build_session", "checkpointed", "scratch_path"]

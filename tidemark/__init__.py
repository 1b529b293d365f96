"""Feature tables, training sets and model monitoring as Spark jobs."""

from tidemark.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]

"""verbatide: labelled short-text analytics as Spark DataFrame jobs."""

from verbatide.session import build_session

__all__ = ["build_session"]

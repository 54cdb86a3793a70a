"""Shelfmark: Spark-native ingestion and analytics for a multi-source book platform."""

from shelfmark.session import build_session, configure

__all__ = ["build_session", "configure"]

"""Commerce analytics as Spark jobs: ingest, quality, reports, catalogue, exploration, lifecycle."""

from tradewind.session import configure, local_session, workspace

__all__ = ["configure", "local_session", "workspace"]

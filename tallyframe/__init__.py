"""tallyframe: corpus relevance, ordered series, latency, detection evaluation
and classifier training as PySpark DataFrame operators."""

from tallyframe.session import build_session, tune

__all__ = ["build_session", "tune"]

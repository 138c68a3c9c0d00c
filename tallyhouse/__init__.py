"""Order analytics on Spark: cleaning, facts, marts, reports, profiling and gates."""

from tallyhouse.session import build_session, configure

__all__ = ["build_session", "configure"]

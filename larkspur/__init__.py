"""larkspur: catalogue, social, graph, language, key-value and ride jobs as Spark DataFrames."""

from larkspur.session import build_session, configure

__all__ = ["build_session", "configure"]

"""Registered queries of the text operators."""

from __future__ import annotations

from larkspur.llm import (
    contamination,
    conversations,
    interpolation,
    language,
    lengths,
    mixing,
    paragraphs,
    quality,
    rules,
    search,
    secrets,
    simhash,
    suffixes,
)
from larkspur.plans.registry import Query

QUERIES: dict[str, Query] = {
    **interpolation.QUERIES,
    **simhash.QUERIES,
    **paragraphs.QUERIES,
    **mixing.QUERIES,
    **secrets.QUERIES,
    **language.QUERIES,
    **contamination.QUERIES,
    **lengths.QUERIES,
    **quality.QUERIES,
    **rules.QUERIES,
    **conversations.QUERIES,
    **search.QUERIES,
    **suffixes.QUERIES,
}

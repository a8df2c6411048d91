"""Row predicates over text columns. NULL never satisfies a predicate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)


def contains_in_any(columns: Sequence[str], term: str) -> Column:
    """Case-sensitive: some of ``columns`` holds ``term``."""
    return any_of([F.col(c).contains(term) for c in columns])

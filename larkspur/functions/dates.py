"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POST_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_millis(column: str) -> Column:
    """Milliseconds since the epoch, for TIMESTAMP and (read as UTC) TIMESTAMP_NTZ columns."""
    return F.unix_millis(F.col(column).cast("timestamp"))


def post_time(column: str) -> Column:
    """Parse a post's timestamp text; unreadable text gives NULL, which sorts first."""
    return F.try_to_timestamp(F.col(column), F.lit(POST_FORMAT))


def post_time_text(column: str | Column) -> Column:
    """Format a timestamp the way posts store it."""
    return F.date_format(column, POST_FORMAT)

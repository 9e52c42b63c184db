"""Column expressions used by the cleaning and enrichment steps.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order statuses left out of financial figures.
EXCLUDED_STATUSES = ("PENDING", "CANCELLED")


def try_cast(column: str | Column, data_type: str) -> Column:
    """Cast that turns malformed input into NULL, also under ANSI mode.

    A zone in the text counts: ``timestamp_ntz`` holds the instant's time in the session zone (UTC).
    """
    col = F.col(column) if isinstance(column, str) else column
    if data_type == "timestamp_ntz":
        return col.try_cast("timestamp").cast("timestamp_ntz")
    return col.try_cast(data_type)


def initcap_trim(column: str | Column) -> Column:
    """``initcap(trim(lower(c)))``: trims spaces only, words break on spaces."""
    col = F.col(column) if isinstance(column, str) else column
    return F.initcap(F.trim(F.lower(col)))

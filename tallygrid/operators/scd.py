"""Current-version scans of slowly changing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: flag column of the current version.
ACTIVE_FLAG = "adh_active_flag"


def scd2_current(table: DataFrame, *columns: str | Column) -> DataFrame:
    """Current rows of ``table``; the flag and the column list reach the scan."""
    current = table.filter(F.col(ACTIVE_FLAG) == 1)
    return current.select(*columns) if columns else current

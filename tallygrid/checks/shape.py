"""Result shapes both engines can print alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType


def shown(frame: DataFrame) -> DataFrame:
    """Decimals as doubles with six decimals, days as ISO text."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = F.round(column, 6).cast("double")
        elif isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            column = F.to_date(column).cast("string")
        columns.append(column.alias(field.name))
    return frame.select(*columns)

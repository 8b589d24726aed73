"""Unbilled-revenue accrual on PySpark DataFrames."""

from tallygrid.params import MonthRange, RunParams

__all__ = ["MonthRange", "RunParams"]

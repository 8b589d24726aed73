"""Accrual models: DataFrames in, DataFrame out."""

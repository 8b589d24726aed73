"""Source tables of the accrual plans."""

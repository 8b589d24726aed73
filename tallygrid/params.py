"""Parameters of one accrual run."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field


def month_floor(day: dt.date) -> dt.date:
    return day.replace(day=1)


def shift_months(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away from the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class MonthRange:
    """Closed range of month start dates."""

    first: dt.date
    last: dt.date

    @property
    def months(self) -> int:
        span = (self.last.year - self.first.year) * 12 + self.last.month - self.first.month
        return max(span + 1, 0)


@dataclass(frozen=True)
class RunParams:
    month_start: dt.date = dt.date(2022, 4, 1)
    period_end: dt.date = dt.date(2023, 4, 30)
    as_of: dt.date = field(default_factory=dt.date.today)
    request_id: int = 25
    seasonality_months: int = 24
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    def __post_init__(self) -> None:
        if self.month_start > self.period_end:
            raise ValueError("month_start must not be after period_end")
        if self.seasonality_months < 1:
            raise ValueError("seasonality_months must be positive")

    @property
    def period_end_text(self) -> str:
        """Result tables keep the period end as ISO date-time text."""
        return f"{self.period_end.isoformat()}T00:00:00"

    @property
    def accrual_range(self) -> MonthRange:
        """Months whose first day lies between ``month_start`` and ``period_end``."""
        first = month_floor(self.month_start)
        if first < self.month_start:
            first = shift_months(first, 1)
        return MonthRange(first, month_floor(self.period_end))

    @property
    def seasonal_range(self) -> MonthRange:
        """``seasonality_months`` months that end six months before ``as_of``."""
        return MonthRange(
            shift_months(self.as_of, -self.seasonality_months - 5),
            shift_months(self.as_of, -6),
        )

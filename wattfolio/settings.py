"""Run parameters. Nothing in the library reads the clock or a settings module."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from wattfolio import fixed


@dataclass(frozen=True)
class SeasonSpan:
    """History up to ``history_end`` against the years ``first_year..curr_year``."""

    curr_year: int
    history_end: str = fixed.HISTORY_END
    first_year: int = fixed.FIRST_YEAR

    def __post_init__(self) -> None:
        date.fromisoformat(self.history_end)
        if self.first_year > self.curr_year:
            raise ValueError("first_year must not lie after curr_year")

    @property
    def years(self) -> list[int]:
        return list(range(self.first_year, self.curr_year + 1))

    @property
    def first_day(self) -> str:
        return f"{self.first_year:04d}-01-01"

    @property
    def last_day(self) -> str:
        return f"{self.curr_year:04d}-12-31"


@dataclass(frozen=True)
class Offset:
    """A yearly amount spread over days by the shares of a reference year."""

    total: float = fixed.OFFSET_TOTAL
    reference_year: int = fixed.OFFSET_REFERENCE_YEAR
    start: str = fixed.OFFSET_START

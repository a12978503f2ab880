"""Run parameters and the reporting period."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal


def _add_months(d: dt.date, months: int) -> dt.date:
    index = d.year * 12 + d.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def reporting_period(run_date: dt.date, quarterly: bool) -> tuple[dt.date, dt.date]:
    """Period closed by the month before ``run_date``.

    The end is the last day of the previous month; a monthly period starts on
    the first of that month, a quarterly one two months earlier (so a run in
    February or March still covers three whole months).
    """
    end = run_date.replace(day=1) - dt.timedelta(days=1)
    start = end.replace(day=1)
    if quarterly:
        start = _add_months(start, -2)
    return start, end


@dataclass(frozen=True)
class RunConfig:
    run_date: dt.date
    quarterly: bool = True
    pct_split: int = 50
    interest_year3: Decimal = Decimal("0.00")
    interest_year4: Decimal = Decimal("0.00")
    ep_prefix: str = "EP"
    out_root: str | None = None
    table_format: str = "parquet"
    history_table: str = "renewals_ldb.renewal_history"
    # Files per period output (reports, exchange file), each one range of the
    # global sort. None leaves the number to Spark; 1 puts the whole output
    # through one task, for a receiving side that needs one physical file.
    output_files: int | None = None

    def __post_init__(self):
        # The share is written as two digits followed by "00" in the exchange file.
        if not 10 <= self.pct_split <= 99:
            raise ValueError(f"pct_split must be two digits, got {self.pct_split}")
        object.__setattr__(self, "interest_year3", Decimal(self.interest_year3))
        object.__setattr__(self, "interest_year4", Decimal(self.interest_year4))

    @property
    def period(self) -> tuple[dt.date, dt.date]:
        return reporting_period(self.run_date, self.quarterly)

    @property
    def start(self) -> dt.date:
        return self.period[0]

    @property
    def end(self) -> dt.date:
        return self.period[1]

    @property
    def run_stamp(self) -> str:
        return self.run_date.strftime("%d%m%y")

    def monthly(self) -> "RunConfig":
        return RunConfig(**{**self.__dict__, "quarterly": False})

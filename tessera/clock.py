"""One clock per run.

Every time-dependent value of a run (Period, Last_Update_Date, window ends,
``CURRENT_DATE`` in rule bounds) is read from a single ``RunClock`` so that a run
is reproducible and all rows of one run carry the same stamps.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunClock:
    now: dt.datetime

    @staticmethod
    def utcnow() -> "RunClock":
        return RunClock(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0))

    @staticmethod
    def fixed(value: str | dt.datetime) -> "RunClock":
        if isinstance(value, str):
            value = dt.datetime.fromisoformat(value)
        return RunClock(value.replace(tzinfo=None))

    @property
    def period(self) -> dt.date:
        return self.now.date()

    @property
    def today_start(self) -> dt.datetime:
        return dt.datetime.combine(self.now.date(), dt.time())

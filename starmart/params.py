"""Run parameters and the fixed values the tables share."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values.
UNKNOWN = "unknown"
UNATTRIBUTED = "unattributed"
UNKNOWN_DATE = dt.date(1900, 1, 1)
DEFAULT_WATERMARK = dt.datetime(2023, 1, 1)
DEFAULT_LOOKBACK_DAYS = 3


@dataclass(frozen=True)
class MartParams:
    """What a run depends on besides its input tables.

    ``as_of`` drives the today/yesterday flags and ``run_ts`` the ``loaded_at`` column; left at
    None they are the clock, given they make a rerun reproduce the same rows.
    """

    calendar_start: dt.date = dt.date(2020, 1, 1)
    calendar_end: dt.date = dt.date(2035, 12, 31)
    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None
    # Largest row count of a dimension that is still broadcast; above it the joins shuffle.
    broadcast_rows: int = 100_000

"""Run parameters.

The reference hard-codes its windows and reads the clock; here they are
parameters whose defaults are the reference's values.  ``as_of`` stands
for "today" and must be passed explicitly wherever a result is compared.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    # Fixed values that must equal the reference's (defaults of the windows).
    close_from: dt.date = dt.date(2026, 2, 1)
    close_to: dt.date = dt.date(2028, 1, 31)
    report_from: dt.date = dt.date(2026, 2, 1)
    lookback_days: int = 730
    sentinel: str = "NIL_ACS_SFDC"
    spine_from: dt.date = dt.date(2015, 1, 1)
    spine_to: dt.date = dt.date(2040, 1, 1)
    # Not taken from the reference: "today" and the tenant's own mail domain
    # word that marks internal activities (None: no activity is internal).
    as_of: dt.date = field(default_factory=dt.date.today)
    tenant_pattern: str | None = None

    @property
    def lookback_start(self) -> dt.date:
        return self.as_of - dt.timedelta(days=self.lookback_days)

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)


# Parameters used with the test tables in /root/testdata (FIXTURES.md part C):
# the windows are moved onto the years the generated data covers.
TEST_PARAMS = Params(
    close_from=dt.date(1997, 2, 1),
    close_to=dt.date(1999, 1, 31),
    report_from=dt.date(2024, 1, 15),
    as_of=dt.date(2026, 1, 10),
    tenant_pattern="acme",
)

"""What a series table looks like: its time column, series keys, tie order and column roles."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

# Column roles of the hourly sensor table (raw header names).
RAW_TARGETS = ("CO(GT)", "NMHC(GT)", "C6H6(GT)", "NOx(GT)", "NO2(GT)")
RAW_SENSORS = ("PT08.S1(CO)", "PT08.S2(NMHC)", "PT08.S3(NOx)", "PT08.S4(NO2)", "PT08.S5(O3)")
RAW_WEATHER = ("T", "RH", "AH")


@dataclass(frozen=True)
class SeriesSpec:
    """Names and placement of a series table, passed to every operator.

    ``ts`` and ``tiebreak`` together must order the rows of one series; ``by`` holds the
    series keys (empty: the table is one series). ``layout`` says how window operators
    spread the time axis:

    * ``"direct"``  - one window partition per series. Only for series of a known small size.
    * ``"blocked"`` - rows get a dense position and windows run over blocks of positions.
    * ``"auto"``    - direct when the longest series has at most ``max_direct_rows`` rows.
    * ``"indexed"`` - set by :func:`seriesprep.layout.place`; the table carries ``_pos``, and ``rows`` says how many rows it has.
    """

    ts: str = "timestamp"
    by: tuple[str, ...] = ()
    tiebreak: tuple[str, ...] = ()
    targets: tuple[str, ...] = ()
    features: tuple[str, ...] = ()
    layout: str = "auto"
    block_rows: int | None = None
    max_direct_rows: int = 500_000
    rows: int | None = None

    @property
    def signals(self) -> tuple[str, ...]:
        return self.targets + self.features

    def keyed(self, *extra: str) -> SeriesSpec:
        """The same table with more series keys, for example the split label."""
        return replace(self, by=self.by + tuple(extra))

    def using(self, **changes) -> SeriesSpec:
        return replace(self, **changes)


SENSORS = SeriesSpec(targets=RAW_TARGETS, features=RAW_SENSORS + RAW_WEATHER)


def safe_name(raw: str) -> str:
    """Lower case, every run of other characters to one underscore, none at the end."""
    return re.sub(r"[^0-9a-z]+", "_", raw.strip().lower()).rstrip("_")


def safe_names(raw: list[str]) -> dict[str, str]:
    """Map raw header names to distinct safe identifiers, in order."""
    out: dict[str, str] = {}
    taken: set[str] = set()
    for name in raw:
        base = safe_name(name) or "c"
        fresh, n = base, 2
        while fresh in taken:
            fresh, n = f"{base}_{n}", n + 1
        taken.add(fresh)
        out[name] = fresh
    return out

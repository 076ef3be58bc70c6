"""Column roles of a panel: one row per (entity, period) with a measure, a 0/1 flag
and numeric covariates. Every operator takes a ``PanelSpec`` instead of
hard-wired column names, so the same operator works on any panel."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class PanelSpec:
    entity: str = "entity"
    time: str = "dt"
    value: str = "value"
    flag: str = "flag"
    covariates: tuple[str, ...] = ("cov_a", "cov_b", "cov_c", "cov_d")
    # Money is summed exactly as DECIMAL(precision, scale) and published as DOUBLE.
    # ``None`` sums the measure as DOUBLE instead (non-money measures).
    value_scale: int | None = 2
    value_precision: int = 18
    # Extra columns that make (entity, time) order total when duplicates remain.
    tie_break: tuple[str, ...] = field(default_factory=tuple)

    def with_(self, **kw) -> "PanelSpec":
        return replace(self, **kw)

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tie_break]


DEFAULT = PanelSpec()

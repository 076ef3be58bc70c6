"""strata — panel analytics on Spark: lazy DataFrame-to-DataFrame operators for
loading, profiling, cleaning, feature building, roll-ups, time-series analysis,
KPIs and distribution summaries over any (entity, period, measure) table."""

from .spec import DEFAULT, PanelSpec

__all__ = ["DEFAULT", "PanelSpec"]

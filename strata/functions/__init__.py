from .dates import DATE_FORMATS, SEASON_ORDER, date_votes, parse_date, parse_date_ordered, parse_date_voted, season, season_ordinal, week_start
from .numeric import exact_avg, exact_sum, growth_pct, money, plain_avg, publish, r2, ratio_pct
from .ranking import exact_quantiles, global_rank, positions
from .scalars import with_scalars

__all__ = [
    "DATE_FORMATS", "SEASON_ORDER", "date_votes", "parse_date", "parse_date_ordered", "parse_date_voted", "season", "season_ordinal", "week_start",
    "exact_avg", "exact_sum", "growth_pct", "money", "plain_avg", "publish", "r2", "ratio_pct",
    "exact_quantiles", "global_rank", "positions", "with_scalars",
]

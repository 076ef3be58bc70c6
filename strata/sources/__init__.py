from .panel import DIRTY, FLAG_WEEKS, PANEL, daily_orders, dirty_panel, gappy_panel, weekly_panel
from .sinks import save, save_bucketed
from .tables import WEEKLY_SALES, load_csv, load_csv_checked, load_weekly_sales, read_table, weekly_sales_schema

__all__ = [
    "DIRTY", "FLAG_WEEKS", "PANEL", "daily_orders", "dirty_panel", "gappy_panel", "weekly_panel",
    "save", "save_bucketed", "load_csv", "load_csv_checked", "load_weekly_sales", "read_table", "weekly_sales_schema", "WEEKLY_SALES",
]

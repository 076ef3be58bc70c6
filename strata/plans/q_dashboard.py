"""Queries for the composed dashboards (inventory K13 and V10), each as one long table."""

from __future__ import annotations

from ..operators import distribution as DI
from ..operators import kpi as K
from ..spec import DEFAULT as SPEC
from .registry import ORACLE, panel, publish, register


def _long(sections: dict[str, tuple[str, tuple[str, ...], str]]) -> str:
    """sections: name -> (query key, key columns, numbers). Each number of each row is a row."""
    ctes, parts = [], []
    for i, (name, (query, keys, metrics)) in enumerate(sections.items()):
        ctes.append(f"s{i} AS ({ORACLE[query]})")
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys) or "''"
        parts += [f"SELECT '{name}' AS Section, {key} AS Row_Key, '{m}' AS Metric, CAST({m} AS DOUBLE) AS Value FROM s{i}" for m in metrics.split()]
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


_KPIS = {
    "revenue": ("revenue_kpi", (), "Total_Revenue Avg_Weekly_Revenue Avg_Revenue_Per_Entity"),
    "revenue_by_year": ("revenue_by_year", ("Year",), "Annual_Revenue"),
    "growth": ("mom_growth", ("Year", "Month"), "Monthly_Sales Prev_Month_Sales MoM_Growth_Pct"),
    "store_performance": (
        "entity_kpi", ("entity",),
        "Total_Sales Avg_Weekly_Sales Peak_Sales Lowest_Sales Sales_StdDev Data_Points Consistency_Score Performance_Score",
    ),
    "holiday_impact": ("flag_kpi", (), "Non_Flag_Avg Flag_Avg Flag_Uplift_Pct Flag_Revenue_Pct Flag_Rows Non_Flag_Rows"),
    "seasonal": ("season_kpi", ("Season",), "Total_Sales Avg_Sales Week_Count Revenue_Contribution_Pct Season_Rank"),
    "efficiency": (
        "entity_efficiency", ("entity",),
        "Avg_Sales Peak_Sales Low_Sales Avg_Capacity_Utilization_Pct Sales_Range Consistency_Index",
    ),
}


@register("kpi_dashboard", _long(_KPIS))
def kpi_dashboard(spark, sf):
    return publish(K.dashboard_table(panel(spark, sf), SPEC))


_CHARTS = {
    "series": ("series_points", ("dt",), "Total_Sales Entities"),
    "top_entities": ("top_entities", ("entity",), "Total_Sales"),
    "bottom_entities": ("bottom_entities", ("entity",), "Total_Sales"),
    "seasons": ("season_avg", ("Season",), "Avg_Sales Season_Order"),
    "months": ("seasonality_month", ("Month",), "Avg_Sales Total_Sales Data_Points"),
    "flag_impact": ("flag_kpi", (), "Non_Flag_Avg Flag_Avg Flag_Uplift_Pct Flag_Revenue_Pct Flag_Rows Non_Flag_Rows"),
    "histogram": ("histogram", ("Bin",), "Bin_Start Bin_End Row_Count"),
    "box": (
        "box_summary", (),
        "Count Min Q1 Median Q3 IQR Lower_Fence Upper_Fence Whisker_Low Whisker_High Outlier_Count Max",
    ),
    "correlation": ("correlation_matrix", ("X", "Y"), "Corr"),
    "years": ("revenue_by_year", ("Year",), "Annual_Revenue"),
}


@register("chart_dashboard", _long(_CHARTS))
def chart_dashboard(spark, sf):
    return publish(DI.chart_table(panel(spark, sf), SPEC))

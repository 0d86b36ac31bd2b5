"""Every quality and value report over stored tables, by name."""

from pyspark.sql import DataFrame

from ratecal.operators import quality, value
from ratecal.operators.grid import observed_cells
from ratecal.schemas import HOTEL
from ratecal.sources.tables import export_csv


def raw_reports(raw: DataFrame) -> dict[str, DataFrame]:
    """Of a raw table, cash or points: what was scraped, when, and which ids are stored twice."""
    return {
        "groups": quality.span_by(raw, "hotel_group").orderBy("hotel_group"),
        "hotels": quality.span_by(raw, *HOTEL).orderBy("hotel_group", "n"),
        "weekdays": quality.weekday_shares(raw),
        "weeks": quality.weekly_counts(raw, *HOTEL),
        "duplicate_ids": quality.duplicate_ids(raw),
    }


def redundancy_reports(cash_raw: DataFrame) -> dict[str, DataFrame]:
    return {
        "redundancy_groups": quality.redundancy(cash_raw, "hotel_group"),
        "redundancy_hotels": quality.redundancy(cash_raw, *HOTEL),
        "lead_time_price": quality.lead_time_price(cash_raw),
    }


def estimate_reports(estimates: DataFrame) -> dict[str, DataFrame]:
    out = {"fill_count": quality.fill_count(estimates), "coverage": quality.coverage(estimates)}
    for price in ("cash", "points"):
        out[f"error_groups_{price}"] = quality.estimate_error(estimates, price, "hotel_group")
        out[f"error_gaps_{price}"] = quality.estimate_error_by_gap(estimates, price)
    return out


def grid_reports(cash: DataFrame, points: DataFrame, start, end) -> dict[str, DataFrame]:
    """Of the clean tables: how full the grid is and what points are worth. None of them needs
    the empty cells, so all start from the priced ones."""
    cells = observed_cells(cash, points, start, end)
    return {
        "week_weekday_fill": quality.week_weekday_fill(cash, points, start, end),
        "cumulative_coverage": quality.cumulative_coverage(cells),
        "value_groups": value.value_by_group(cells),
        "value_months_booked": value.value_by_month_booked(cells),
        "value_months_of_stay": value.value_by_month_of_stay(cells),
        "value_tiers": value.value_by_tier(cells),
        "value_months_ahead": value.value_by_months_ahead(cells),
    }


def export_reports(reports: dict[str, DataFrame], folder: str) -> None:
    for name, report in reports.items():
        export_csv(report, f"{folder}/{name}")

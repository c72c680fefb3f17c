"""The tables behind all charts of one cleaned table.

Building them starts jobs of their own, for limits, quantiles and moments that the plans then hold as numbers: store the cleaned
table first.
"""

from pyspark.sql import DataFrame

from parcelframe import fixed
from parcelframe.operators import distributions, stats


def chart_tables(clean: DataFrame, key: str) -> dict[str, DataFrame]:
    reports = {
        "price_histogram": distributions.histogram(clean, bins=None),
        "log_price_histogram": distributions.histogram(clean, bins=None, log=True),
        "price_density": distributions.density(clean),
        "price_by_city_boxplot": distributions.boxplot_by(clean),
        "correlation_matrix": stats.corr_matrix(clean),
        "top_cities": stats.mean_by(clean, "city_province", top=10),
        "property_map": stats.city_map_stats(clean, fixed.CITY_POSITIONS),
        "price_vs_area": distributions.area_price_points(clean, key, trim=None),
    }
    reports.update({f"price_by_{c}": stats.mean_by_number(clean, c) for c in ("bedroom_num", "floor_num", "toilet_num")})
    reports.update({f"price_by_{c}": stats.mean_by(clean, c) for c in ("category", "direction", "liability")})
    return reports

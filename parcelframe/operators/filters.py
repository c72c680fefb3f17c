"""Row filters and per-row checks."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelframe import fixed
from parcelframe.operators.quantiles import column_quantile, quantile_values


def filter_price_present(df: DataFrame, price: str = "price") -> DataFrame:
    return df.filter(F.col(price).isNotNull())


def filter_area_positive(df: DataFrame, area: str = "area") -> DataFrame:
    """Rows with a positive area; NaN, which Spark orders above all numbers, is none."""
    return df.filter((F.col(area) > 0) & ~F.isnan(F.col(area).cast("double")))


def filter_price_per_m2_band(
    df: DataFrame, value: str = "price_per_m2", band: tuple[float, float] = fixed.PRICE_PER_M2_BAND
) -> DataFrame:
    return df.filter(F.col(value).between(*band))


def filter_price_range(
    df: DataFrame, value: str = "price_per_m2", low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows inside a range, both ends included; an open end defaults to the lower or upper quartile."""
    if low is None or high is None:
        quartiles = quantile_values(df, value, {"p25": 0.25, "p75": 0.75})
        low = quartiles["p25"] if low is None else low
        high = quartiles["p75"] if high is None else high
    return df.filter(F.col(value).cast("double").between(F.lit(low), F.lit(high)))


def filter_location(df: DataFrame, city: str | None = None, district: str | None = None) -> DataFrame:
    if city is not None:
        df = df.filter(F.col("city_province") == city)
    if district is not None:
        df = df.filter(F.col("district") == district)
    return df


def filter_similar(
    df: DataFrame,
    city: str,
    district: str,
    area: float,
    category: str | None = None,
    share: tuple[float, float] = fixed.SIMILAR_AREA_SHARE,
) -> DataFrame:
    """Listings comparable with one subject; both area limits are exclusive."""
    size = F.col("area_m2").cast("double")
    found = filter_location(df, city, district).filter((size > area * share[0]) & (size < area * share[1]))
    return found if category is None else found.filter(F.col("category") == category)


def trim_p99_joint(df: DataFrame, columns: Sequence[str] = ("price_per_m2", "area_m2"), prob: float = 0.99) -> DataFrame:
    """Rows strictly below the quantile of every column, all quantiles taken from the same table in one job."""
    for c, cut in column_quantile(df, columns, prob).items():
        df = df.filter(F.col(c).cast("double") < F.lit(cut))
    return df


def trim_p99_sequential(
    df: DataFrame, columns: Sequence[str] = ("price_per_m2", "area_m2"), prob: float = 0.99
) -> DataFrame:
    """As above, but each quantile is taken from what the filters before it left over."""
    for c in columns:
        df = df.filter(F.col(c).cast("double") < F.lit(quantile_values(df, c, {"cut": prob})["cut"]))
    return df


def filter_text_contains(df: DataFrame, column: str, part: str, negate: bool = False) -> DataFrame:
    """Rows whose text has, or on request lacks, a substring; a null text is never kept."""
    found = F.col(column).contains(part)
    return df.filter(~found if negate else found)


def contains_ignoring_case(text: Column, part: Column) -> Column:
    return F.coalesce(F.lower(text).contains(F.lower(part)), F.lit(False))


def filter_text_icontains(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(contains_ignoring_case(F.col(column), F.lit(part)))


def _outside(column: str, low, high) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def validate_listing(
    df: DataFrame,
    required: Iterable[str] = fixed.CATEGORICAL_FEATURES + fixed.NUMERIC_FEATURES,
    year: str | None = None,
    as_of_year: int | None = None,
) -> DataFrame:
    """Adds ``errors`` and ``warnings`` (arrays of codes) and ``is_valid``.

    Errors: ``missing:<column>``, ``area_not_positive`` and ``out_of_range:<column>``. Warnings:
    ``area_too_small`` and, when a year column is named, ``unusual_year`` for a year after ``as_of_year``.
    """
    errors = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required]
    errors.append(F.when(F.col("area_m2") <= 0, F.lit("area_not_positive")))
    errors += [
        F.when(_outside(c, low, high), F.lit(f"out_of_range:{c}"))
        for c, (low, high) in fixed.INPUT_LIMITS.items()
        if c in df.columns
    ]
    warnings = [F.when(F.col("area_m2") < fixed.SMALL_AREA_M2, F.lit("area_too_small"))]
    if year is not None:
        latest = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
        warnings.append(F.when(F.col(year) > latest, F.lit("unusual_year")))
    return df.withColumns(
        {"errors": F.array_compact(F.array(*errors)), "warnings": F.array_compact(F.array(*warnings))}
    ).withColumn("is_valid", F.size("errors") == 0)

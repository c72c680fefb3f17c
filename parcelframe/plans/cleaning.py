"""The two cleaning dialects: raw listing texts to a typed table.

Dialect A reads prices as totals and derives the price per square metre; dialect B reads them as
prices per square metre. Extra columns of the input pass through unchanged.
"""

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelframe import fixed
from parcelframe.functions import numbers, text
from parcelframe.operators import columns as cols
from parcelframe.operators import filters, quantiles, stats

_UNUSED = ("link", "title")
Step = Callable[[DataFrame, str], DataFrame]


def _unseen(df: DataFrame, _name: str) -> DataFrame:
    return df


def split_location(df: DataFrame, location: str = "location") -> DataFrame:
    """Replaces the location by ``district`` and ``city_province``."""
    district, city = text.location_parts(F.col(location))
    return df.withColumns({"district": district, "city_province": city}).drop(location)


def _filled(df: DataFrame, unused: Iterable[str], step: Step) -> DataFrame:
    return (
        # A null price or area never survives; saying so first lets the scan skip those rows.
        step(df, "read")
        .filter(F.col("price").isNotNull() & F.col("area").isNotNull())
        .transform(step, "with_texts")
        .transform(cols.drop_columns, unused)
        .transform(cols.fill_numeric_sentinel)
        .transform(cols.fill_categorical_unknown)
        .transform(split_location)
    )


def _typed(df: DataFrame, price: Column) -> DataFrame:
    """Typed columns in place of the texts.

    Price and area come out of a generator: filters on them stay above it, so that Catalyst does not
    copy the parsing into every filter and run it several times per row.
    """
    measured = F.struct(price.alias("price"), text.parse_area(F.col("area")).alias("area"))
    rest = [c for c in df.columns if c not in ("price", "area", "street")]
    parsed = {
        "floor_num": text.parse_floor(F.col("floor_num")),
        "bedroom_num": text.parse_bedroom(F.col("bedroom_num")),
        "toilet_num": text.whole_number(F.col("toilet_num")),
        "livingroom_num": text.whole_number(F.col("livingroom_num")),
    }
    return df.select(
        F.inline(F.array(measured)),
        *[parsed.get(c, F.col(c)).alias(c) for c in rest],
        text.parse_street_width(F.col("street")).alias("street_width"),
    )


def clean_listings_a(df: DataFrame, unused: Iterable[str] = _UNUSED, step: Step = _unseen) -> DataFrame:
    """``step`` is handed the table after each step that drops rows, with the step's name."""
    return (
        _typed(_filled(df, unused, step), text.parse_price_total(F.col("price")))
        .transform(filters.filter_price_present)
        .transform(step, "priced")
        .transform(filters.filter_area_positive)
        .transform(step, "with_area")
        .withColumn("price_per_m2", numbers.price_per_m2(F.col("price"), F.col("area")))
        .transform(filters.filter_price_per_m2_band)
        .transform(step, "in_band")
        .transform(cols.cast_types, {"price_per_m2": "float"})
        .transform(cols.rename_columns, {"area": "area_m2", "street_width": "street_width_m"})
    )


def clean_listings_b(df: DataFrame, unused: Iterable[str] = _UNUSED, step: Step = _unseen) -> DataFrame:
    """Keeps every listing with a readable price; there is no area or price band filter."""
    return (
        _typed(_filled(df, unused, step), text.parse_price_unit(F.col("price")))
        .transform(filters.filter_price_present)
        .transform(step, "priced")
        .transform(
            cols.rename_columns, {"price": "price_per_m2", "area": "area (m2)", "street_width": "street (m)"}
        )
    )


def with_step_counts(
    df: DataFrame, clean: Callable[..., DataFrame] = clean_listings_a, **options
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The cleaned table, and a function that gives the rows left after each step and the rows the step dropped.

    The counts are observed by the first job that runs over the whole cleaned table, such as its write, and cost no job of their
    own; call the function after that. Observing keeps the scan from skipping rows without a price or an area.
    """
    seen = {}

    def step(table: DataFrame, name: str) -> DataFrame:
        table, seen[name] = stats.observed_count(table, f"{name}-{uuid.uuid4().hex}")
        return table

    cleaned = clean(df, step=step, **options)

    def counts() -> DataFrame:
        left = [(name, one.get["rows"]) for name, one in seen.items()]
        before = [left[0][1], *[rows for _name, rows in left[:-1]]]
        rows = [(i, name, n, b - n) for i, ((name, n), b) in enumerate(zip(left, before, strict=True))]
        return df.sparkSession.createDataFrame(rows, "place int, step string, rows bigint, dropped bigint")

    return cleaned, counts


def prepare_model_frame(
    df: DataFrame, numeric: Iterable[str] = fixed.NUMERIC_FEATURES, exact: bool = True
) -> DataFrame:
    """Missing flags, medians in place of -1, and the log label."""
    numeric = list(numeric)
    flagged = cols.missing_flags(df, numeric)
    return impute_median(flagged, numeric, exact).withColumn(
        "price_log", numbers.log_price(F.col("price_per_m2").cast("double"))
    )


def impute_median(df: DataFrame, columns: Iterable[str], exact: bool = True) -> DataFrame:
    """-1 becomes the median of the other values; a null stays null.

    The medians, exact or within one percent of rank, are found first, by one job for all columns.
    """
    columns = list(columns)
    medians = quantiles.exact_medians(df, columns) if exact else quantiles.approx_medians(df, columns)
    return df.withColumns(
        {
            c: F.when(F.col(c) == fixed.MISSING_NUMBER, F.lit(medians[c]).cast("double"))
            .otherwise(F.col(c).cast("double"))
            for c in columns
        }
    )

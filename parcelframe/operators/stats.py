"""Descriptive aggregates. Groups with a null key are left out; averages are taken over doubles."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelframe import fixed
from parcelframe.functions import numbers
from parcelframe.operators.columns import numeric_columns, present
from parcelframe.operators.filters import contains_ignoring_case
from parcelframe.operators.quantiles import exact_quantiles, quantile_values

PRICE = "price_per_m2"


def _double(column: str) -> Column:
    return F.col(column).cast("double")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def observed_count(df: DataFrame, name: str, columns: Sequence[str] = ()):
    """The table unchanged plus an observation of its row and null counts, filled by the next action on it."""
    from pyspark.sql import Observation

    seen = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    return df.observe(seen, F.count("*").alias("rows"), *nulls), seen


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls of every column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns or df.columns])


def quick_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.avg(_double(PRICE)).alias("avg_price_per_m2"),
        F.avg(_double("area_m2")).alias("avg_area_m2"),
        F.count_distinct("city_province").alias("cities"),
    )


def price_summary(df: DataFrame, value: str = PRICE) -> DataFrame:
    """Mean, exact median, maximum, minimum and count of a column."""
    basic = df.agg(
        F.avg(_double(value)).alias("mean"),
        F.max(_double(value)).alias("max"),
        F.min(_double(value)).alias("min"),
        F.count(value).alias("count"),
    )
    return basic.withColumn("median", F.lit(quantile_values(df, value, {"p50": 0.5})["p50"]))


def mean_by(
    df: DataFrame, keys: str | Sequence[str], value: str = PRICE, name: str = "avg_price", top: int | None = None
) -> DataFrame:
    """Mean per group, highest first, ties by key; optionally only the first ``top`` groups."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    groups = present(df, keys).groupBy(*keys).agg(F.avg(_double(value)).alias(name))
    ordered = groups.orderBy(F.desc(name), *keys)
    return ordered if top is None else ordered.limit(top)


def mean_by_number(df: DataFrame, key: str, value: str = PRICE, name: str = "avg_price") -> DataFrame:
    """Mean per value of a numeric column, in numeric order."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(_double(value)).alias(name)).orderBy(key)


def median_by(
    df: DataFrame, key: str, value: str = PRICE, name: str = "median_price", top: int | None = None
) -> DataFrame:
    ordered = exact_quantiles(df, value, {name: 0.5}, [key]).orderBy(F.desc(name), key)
    return ordered if top is None else ordered.limit(top)


def count_by(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(F.desc("count"), key)
    return ordered if top is None else ordered.limit(top)


def region_overview(df: DataFrame, columns: Sequence[str] = ("city_province", "district")) -> DataFrame:
    """Per column: how many values, the most frequent one and the largest and smallest group."""

    def overview(column: str) -> DataFrame:
        groups = count_by(df, column).withColumnRenamed(column, "value")
        # Among equally frequent values the alphabetically first one wins.
        best = F.min(F.struct((-F.col("count")).alias("order"), "value"))
        return groups.agg(
            F.lit(column).alias("column"),
            F.count("*").alias("groups"),
            best["value"].alias("most_frequent"),
            F.max("count").alias("largest_group"),
            F.min("count").alias("smallest_group"),
        )

    return reduce(DataFrame.unionByName, [overview(c) for c in columns])


def distinct_options(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted distinct values of several columns as (column, value) rows."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(cells)).filter(F.col("value").isNotNull()).distinct().orderBy("column", "value")


def districts_by_city(df: DataFrame) -> DataFrame:
    """Sorted distinct (city, district) pairs, the second choice that depends on the first."""
    pair = ["city_province", "district"]
    return present(df, pair).select(*pair).distinct().orderBy(*pair)


def pair_corr(df: DataFrame, left: str = PRICE, right: str = "area_m2") -> DataFrame:
    return df.agg(F.corr(_double(left), _double(right)).alias("corr"))


def corr_matrix(df: DataFrame, columns: Sequence[str] = fixed.NUMERIC_FEATURES + (PRICE,)) -> DataFrame:
    """Pearson matrix in long form, one pass, each pair over the rows where both are present."""
    pairs = {
        (i, j): F.corr(_double(columns[i]), _double(columns[j])).alias(f"c{i}_{j}")
        for i in range(len(columns))
        for j in range(i)
    }
    spread = {i: F.max(_double(c)) > F.min(_double(c)) for i, c in enumerate(columns)}
    wide = df.agg(*pairs.values(), *[s.alias(f"v{i}") for i, s in spread.items()])

    def cell(i: int, j: int) -> Column:
        value = F.when(F.col(f"v{i}"), F.lit(1.0)) if i == j else F.col(f"c{max(i, j)}_{min(i, j)}")
        return F.struct(F.lit(columns[i]).alias("row"), F.lit(columns[j]).alias("column"), value.alias("corr"))

    n = range(len(columns))
    return wide.select(F.inline(F.array(*[cell(i, j) for i in n for j in n])))


def corr_matrix_wide(df: DataFrame, columns: Sequence[str] = fixed.NUMERIC_FEATURES + (PRICE,)) -> DataFrame:
    """The same matrix with one column per variable."""
    cells = [F.max(F.when(F.col("column") == c, F.col("corr"))).alias(c) for c in columns]
    return corr_matrix(df, columns).groupBy("row").agg(*cells)


def price_quantiles(df: DataFrame, value: str = PRICE, accuracy: int | None = None) -> DataFrame:
    """p01, p25, p75 and p99: exact, or within the given sketch accuracy."""
    probs = {"p01": 0.01, "p25": 0.25, "p75": 0.75, "p99": 0.99}
    if accuracy is None:
        return exact_quantiles(df, value, probs)
    return df.agg(*[F.percentile_approx(_double(value), p, accuracy).alias(name) for name, p in probs.items()])


def trimmed_price_range(df: DataFrame, value: str = PRICE) -> DataFrame:
    """Largest value below p99 minus smallest value above p01."""
    cut = quantile_values(df, value, {"p01": 0.01, "p99": 0.99})
    price = _double(value)
    return df.agg(
        (F.max(F.when(price < F.lit(cut["p99"]), price)) - F.min(F.when(price > F.lit(cut["p01"]), price))).alias("price_range")
    )


def monthly_price_trend(df: DataFrame, posted: Column, value: str = PRICE) -> DataFrame:
    """Mean price per month of the year; rows without a month are left out."""
    return mean_by_number(df.withColumn("posting_month", posted), "posting_month", value)


def city_map_stats(
    df: DataFrame, positions: Mapping[str, tuple[float, float]] = fixed.CITY_POSITIONS, value: str = PRICE
) -> DataFrame:
    """Position, mean price, listing count and label per mapped city.

    A listing belongs to a city when its place name contains the city's name, in any case; cities
    without listings are absent. The listings are first reduced to one row per place name, so the
    list of cities, a fixed argument, is only matched against place names.
    """
    places = (
        df.filter(F.col("city_province").isNotNull())
        .groupBy("city_province")
        .agg(F.count("*").alias("n"), F.count(value).alias("priced"), F.sum(_double(value)).alias("amount"))
    )
    cities = F.array(
        *[
            F.struct(F.lit(c).alias("city"), F.lit(float(lat)).alias("lat"), F.lit(float(lon)).alias("lon"))
            for c, (lat, lon) in positions.items()
        ]
    )
    named = F.filter(cities, lambda c: contains_ignoring_case(F.col("city_province"), c["city"]))
    stats = (
        places.select("n", "priced", "amount", F.explode(named).alias("at"))
        .groupBy("at.city", "at.lat", "at.lon")
        .agg((F.sum("amount") / F.sum("priced")).alias("avg_price"), F.sum("n").alias("count"))
    )
    label = F.concat(F.col("city"), F.lit(": "), numbers.format_thousands(F.col("avg_price")), F.lit(" VND/m²"))
    return stats.withColumn("label", label)


def range_selection_summary(df: DataFrame, low: Column | float, high: Column | float, value: str = PRICE) -> DataFrame:
    """Count, share in whole percent, mean price and mean area of the rows inside a price range."""
    chosen = _double(value).between(low, high)
    return df.agg(
        F.count_if(chosen).alias("selected"),
        F.count("*").alias("total"),
        F.avg(F.when(chosen, _double(value))).alias("avg_price"),
        F.avg(F.when(chosen, _double("area_m2"))).alias("avg_area"),
    ).withColumn("percent", numbers.share_of_total(F.col("selected"), F.col("total")))


def neighborhood_min_avg_max(df: DataFrame, value: str = PRICE) -> DataFrame:
    return (
        present(df, ["city_province", "district"])
        .groupBy("city_province", "district")
        .agg(
            F.min(_double(value)).alias("min_price"),
            F.avg(_double(value)).alias("avg_price"),
            F.max(_double(value)).alias("max_price"),
        )
    )


def feature_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg(_double("area_m2")).alias("avg_area"),
        F.avg(_double("bedroom_num")).alias("avg_bedrooms"),
        F.corr(_double(PRICE), _double("area_m2")).alias("price_area_corr"),
        F.lit(len(numeric_columns(df))).alias("numeric_columns"),
    )

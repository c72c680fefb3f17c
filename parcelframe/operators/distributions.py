"""Tables behind distribution charts."""

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.functions import numbers
from parcelframe.operators import ranking
from parcelframe.operators.filters import trim_p99_joint, trim_p99_sequential
from parcelframe.operators.quantiles import exact_quantiles, quantile_values
from parcelframe.session import stored

PRICE = "price_per_m2"


def _auto_bins(df: DataFrame, value: str, n: int, span: float) -> int:
    """The larger of the Sturges and the Freedman-Diaconis bin counts."""
    quartiles = quantile_values(df, value, {"p25": 0.25, "p75": 0.75})
    spread = quartiles["p75"] - quartiles["p25"]
    by_spread = span / (2 * spread * n ** (-1 / 3)) if spread > 0 else 0
    return max(1, math.ceil(max(math.log2(n) + 1, by_spread)))


def histogram(df: DataFrame, value: str = PRICE, bins: int | None = 50, log: bool = False) -> DataFrame:
    """Counts in equal bins from the smallest to the largest value, empty bins included.

    Null and NaN values are left out. Without a bin count the number follows from size and spread. The last bin includes its end.
    The limits are found first, by one job that returns three numbers.
    """
    x = F.col(value).cast("double")
    source = df
    df = df.select((numbers.log_price(x) if log else x).alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    low, high, n = df.agg(F.min("x"), F.max("x"), F.count("*")).first()
    if not n:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, count bigint")
    if bins is None:
        # The column's own type, where it has one, spares the quantiles the passes that doubles need.
        bins = _auto_bins(df, "x", n, high - low) if log else _auto_bins(source, value, n, high - low)
    width = (high - low) / bins
    place = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
    filled = df.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def trimmed_histogram(df: DataFrame, value: str = PRICE, bins: int = 50) -> DataFrame:
    """Histogram of the values below the 99th percentile."""
    return histogram(trim_p99_sequential(df, [value]), value, bins)


def density(df: DataFrame, value: str = PRICE, points: int = 200, log: bool = False) -> DataFrame:
    """Gaussian kernel density on an even grid from the smallest to the largest value.

    The bandwidth is the sample standard deviation times n^(-1/5); null and NaN values are left out. Rows are first reduced to counted
    distinct values, then every value adds its weight to the fixed number of grid points. Without any
    spread there is no density and the result is empty.
    """
    x = F.col(value).cast("double")
    rows = df.select((numbers.log_price(x) if log else x).alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    low, high, n, deviation = rows.agg(F.min("x"), F.max("x"), F.count("*"), F.stddev_samp("x")).first()
    if not deviation:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    width = deviation * n**-0.2
    at = low + F.col("point") * (high - low) / (points - 1)
    weights = rows.groupBy("x").agg(F.count("*").alias("weight"))
    summed = (
        weights.select("x", "weight", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .groupBy("point")
        .agg(F.sum(F.col("weight") * F.exp(-F.pow((at - F.col("x")) / width, F.lit(2)) / 2)).alias("mass"))
    )
    scale = n * width * math.sqrt(2 * math.pi)
    return summed.select("point", at.alias("x"), (F.col("mass") / scale).alias("density"))


def binned_density(
    df: DataFrame, value: str = PRICE, points: int = 200, log: bool = False, cells_per_width: int = 40
) -> DataFrame:
    """The density of ``density`` for columns of many distinct values, within 1e-4 of its largest value.

    Every value is shared between the two neighbouring cells of a grid, in proportion to its place between them, and the kernel
    is laid over the cells. A bandwidth is ``cells_per_width`` cells, which bounds the error by 1 / (8 x cells_per_width^2) of the curve's
    bend. Only one count and one sum per occupied cell are shuffled, however many values there are; a cell adds to the points within
    eight bandwidths, beyond which the kernel is below 1e-13. Null, NaN and infinite values are left out.
    """
    x = F.col(value).cast("double")
    rows = df.select((numbers.log_price(x) if log else x).alias("x")).filter(F.abs("x") < float("inf"))
    low, high, n, deviation = rows.agg(F.min("x"), F.max("x"), F.count("*"), F.stddev_samp("x")).first()
    if not deviation:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    width = deviation * n**-0.2
    cell = width / cells_per_width
    step = (high - low) / (points - 1)
    place = (F.col("x") - low) / cell
    shares = rows.select(F.floor(place).alias("cell"), (place - F.floor(place)).alias("share"))
    counted = shares.groupBy("cell").agg(F.count("*").alias("n"), F.sum("share").alias("share"))
    weights = counted.select(
        F.inline(
            F.array(
                F.struct(F.col("cell"), (F.col("n") - F.col("share")).alias("weight")),
                F.struct((F.col("cell") + 1).alias("cell"), F.col("share").alias("weight")),
            )
        )
    )
    middle = F.col("cell") * cell
    first = F.greatest(F.ceil((middle - 8 * width) / step), F.lit(0))
    last = F.least(F.floor((middle + 8 * width) / step), F.lit(points - 1))
    near = weights.withColumns({"first": first, "last": last}).filter("first <= last")
    spread = near.select("weight", middle.alias("middle"), F.explode(F.sequence("first", "last")).alias("point"))
    kernel = F.exp(-F.pow((F.col("point") * step - F.col("middle")) / width, F.lit(2)) / 2)
    summed = spread.groupBy("point").agg(F.sum(F.col("weight") * kernel).alias("mass"))
    scale = n * width * math.sqrt(2 * math.pi)
    return (
        df.sparkSession.range(points)
        .select(F.col("id").alias("point"))
        .join(summed, "point", "left")
        .select(
            F.col("point").cast("int").alias("point"),
            (low + F.col("point") * step).alias("x"),
            (F.coalesce("mass", F.lit(0.0)) / scale).alias("density"),
        )
    )


def boxplot_by(df: DataFrame, key: str = "city_province", value: str = PRICE, top: int = 10) -> DataFrame:
    """Box figures of the groups with the highest medians: quartiles, whiskers and outlier count."""
    boxes = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [key])
    boxes = ranking.top_k_groups(boxes, "median", key, top)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(value).cast("double")
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        df.filter(x.isNotNull())
        .join(F.broadcast(boxes), key)
        .groupBy(key, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
            F.count("*").alias("count"),
        )
    )


def area_price_points(
    df: DataFrame,
    key: str,
    n: int | None = 1000,
    trim: str | None = "joint",
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Points of the price over area chart: a sample, optionally cut at the 99th percentiles.

    ``trim`` is ``joint``, ``sequential`` or None; ``columns`` may rename the columns shown.
    """
    if n is not None:
        # At most n rows, kept: the cuts would draw them again.
        df = stored(ranking.sample_n(df, key, n), "sample")
    df = df.withColumn("size_value", numbers.positive_size(F.col("bedroom_num")))
    if trim is not None:
        df = {"joint": trim_p99_joint, "sequential": trim_p99_sequential}[trim](df)
    shown = columns or {
        c: c
        for c in (key, "area_m2", PRICE, "city_province", "size_value", "district", "category", "bedroom_num", "floor_num")
    }
    return df.select(*[F.col(c).alias(name) for c, name in shown.items()])

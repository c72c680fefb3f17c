"""Comparable listings for whole tables of subjects.

A subject's comparables share its place and have an area strictly inside a band around its own. No
subject is ever paired with all listings of its place:

* counts and means add up the area bins inside the band and the parts of the two bins its ends fall into; nothing
  is subtracted, so sums of doubles keep their precision whatever the size of the prices;
* the nearest few come from the handful of distinct areas next to the subject's own, found by their
  ordinal in the place.

Results are worked out once per distinct (place, area) and joined back to the subjects. Everything is split by
logarithmic area bin, so a place that holds most of the table is spread over many tasks.
"""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelframe import fixed
from parcelframe.operators.columns import present
from parcelframe.session import stored

PLACE = ("city_province", "district")
PRICE = "price_per_m2"
AREA = "area_m2"

# Bins per e-fold of the area.
_BINS_PER_EFOLD = 64


def _subjects_at(subjects: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct places and positive areas asked for."""
    area = F.col(AREA).cast("double")
    return present(subjects, keys).filter((area > 0) & ~F.isnan(area)).select(*keys, area.alias("area")).distinct()


def _listings_at(listings: DataFrame, keys: Sequence[str]) -> DataFrame:
    area = F.col(AREA).cast("double")
    return present(listings, [*keys, PRICE]).filter((area > 0) & ~F.isnan(area)).withColumn("area", area)


def _running_totals(events: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Replaces each measure by its total over all events of the same keys up to and including the row.

    Events are ordered by (at, turn). Totals within an area bin are added to those of earlier bins.
    The events, already reduced to distinct areas, are stored: they are read twice, their source once.
    """
    binned = stored(events.withColumn("_bin", F.floor(F.ln("at") * _BINS_PER_EFOLD)), "area-events")
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = binned.groupBy(*keys, "_bin").agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    before = per_bin.select(*keys, "_bin", *[F.sum(f"_{m}").over(earlier).alias(f"_{m}") for m in measures])
    inside = Window.partitionBy(*keys, "_bin").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    local = binned.withColumns({m: F.sum(m).over(inside) for m in measures})
    totals = {m: F.coalesce(F.col(m), F.lit(0)) + F.coalesce(F.col(f"_{m}"), F.lit(0)) for m in measures}
    return local.join(before, [*keys, "_bin"]).withColumns(totals).drop("_bin", *[f"_{m}" for m in measures])


def similar_stats(
    subjects: DataFrame,
    listings: DataFrame,
    keys: Sequence[str] = PLACE,
    share: tuple[float, float] = fixed.SIMILAR_AREA_SHARE,
) -> DataFrame:
    """Per distinct (keys, area) of the subjects: number and mean price of the comparable listings."""
    keys = list(keys)
    # So fine that the two ends of a band never share a bin.
    fine = max(_BINS_PER_EFOLD, math.ceil(3 / math.log(share[1] / share[0])))
    bin_of = lambda area: F.floor(F.ln(area) * fine)
    points = (
        _listings_at(listings, keys)
        .groupBy(*keys, "area")
        .agg(F.count("*").alias("n"), F.sum(F.col(PRICE).cast("double")).alias("amount"))
        .select(*keys, F.col("area").alias("at"), F.lit(1).alias("turn"), "n", "amount", F.lit(None).cast("double").alias("area"))
    )
    # The lower end is read after the listings of that very area, the upper end before them.
    low = F.struct((F.col("area") * share[0]).alias("at"), F.lit(2).alias("turn"))
    high = F.struct((F.col("area") * share[1]).alias("at"), F.lit(0).alias("turn"))
    ends = (
        _subjects_at(subjects, keys)
        .withColumn("end", F.explode(F.array(low, high)))
        .select(*keys, "end.at", "end.turn", F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("amount"), "area")
    )
    # Reduced to distinct areas; read twice, while the source is read once.
    events = stored(points.unionByName(ends).withColumn("bin", bin_of(F.col("at"))), "area-events")
    order = Window.partitionBy(*keys, "bin").orderBy("at", "turn")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    part = {m: F.when(F.col("turn") == 0, F.sum(m).over(before)).when(F.col("turn") == 2, F.sum(m).over(after)) for m in ("n", "amount")}
    parts = events.withColumns(part).filter(F.col("area").isNotNull()).select(*keys, "area", "n", "amount")
    whole = events.filter("turn = 1").groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    inner = F.sequence(bin_of(F.col("area") * share[0]) + 1, bin_of(F.col("area") * share[1]) - 1)
    inside = events.filter("turn = 0").select(*keys, "area", F.explode(inner).alias("bin")).join(whole, [*keys, "bin"])
    return (
        parts.unionByName(inside.select(*keys, "area", "n", "amount"))
        .groupBy(*keys, "area")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_similar"), F.sum("amount").alias("_amount"))
        .withColumn("avg_similar", F.when(F.col("n_similar") > 0, F.col("_amount") / F.col("n_similar")))
        .drop("_amount")
    )


def _with_area(subjects: DataFrame) -> DataFrame:
    return subjects.withColumn("area", F.col(AREA).cast("double"))


def comparables_summary(subjects: DataFrame, listings: DataFrame, subject_key: str, keys=PLACE) -> DataFrame:
    """Per subject: number and mean price of its comparables; 0 and null when it has none."""
    stats = similar_stats(subjects, listings, keys)
    return (
        _with_area(subjects)
        .select(subject_key, *keys, "area")
        .join(stats, [*keys, "area"], "left")
        .select(subject_key, F.coalesce("n_similar", F.lit(0)).cast("bigint").alias("n_similar"), "avg_similar")
    )


def comparables_top(
    subjects: DataFrame,
    listings: DataFrame,
    subject_key: str,
    listing_key: str,
    keys: Sequence[str] = PLACE,
    share: tuple[float, float] = fixed.SIMILAR_AREA_SHARE,
    top: int = fixed.COMPARABLES_SHOWN,
    shown: Sequence[str] = (PRICE, "bedroom_num", "floor_num", "category"),
) -> DataFrame:
    """Up to ``top`` comparables per subject, nearest area first, then lowest key, with their rank.

    Listings of equal area are equally near, so the ``top`` lowest keys per distinct area are enough,
    and of the distinct areas the ``top`` next ones on either side. Both cuts are exact.
    """
    keys = list(keys)
    by_key = Window.partitionBy(*keys, "area").orderBy(listing_key)
    row = F.struct(F.col(listing_key).alias("listing_key"), *shown)
    points = (
        _listings_at(listings, keys)
        .withColumn("_place", F.row_number().over(by_key))
        .filter(F.col("_place") <= top)
        .groupBy(*keys, "area")
        .agg(F.collect_list(row).alias("rows"))
    )
    wanted = _subjects_at(subjects, keys)
    listed = points.select(*keys, F.col("area").alias("at"), F.lit(1).alias("turn"), F.lit(1).alias("ordinal"), "rows")
    asked = wanted.select(
        *keys, F.col("area").alias("at"), F.lit(2).alias("turn"), F.lit(0).alias("ordinal"), F.lit(None).alias("rows")
    )
    placed = _running_totals(listed.unionByName(asked), keys, ("ordinal",))
    areas = placed.filter("turn = 1").select(*keys, "ordinal", F.col("at").alias("similar_area"), "rows")
    neighbours = F.sequence(F.col("ordinal") - (top - 1), F.col("ordinal") + top)
    near = (
        placed.filter("turn = 2")
        .select(*keys, F.col("at").alias("area"), F.explode(neighbours).alias("ordinal"))
        .join(areas, [*keys, "ordinal"])
        .filter(
            (F.col("similar_area") > F.col("area") * share[0]) & (F.col("similar_area") < F.col("area") * share[1])
        )
        .select(*keys, "area", "similar_area", F.inline("rows"))
    )
    nearest = Window.partitionBy(*keys, "area").orderBy(F.abs(F.col("similar_area") - F.col("area")), "listing_key")
    best = near.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= top)
    return _with_area(subjects).select(subject_key, *keys, "area").join(best, [*keys, "area"]).drop("area")


def fallback_estimate(
    subjects: DataFrame,
    listings: DataFrame,
    subject_key: str,
    enough: int = fixed.MIN_SIMILAR,
    default: float = fixed.DEFAULT_PRICE_PER_M2,
) -> DataFrame:
    """Tiered mean price per subject, with the tier that gave it.

    1: comparables of the same category, if enough; 2: the place, if enough; 3: the city, if any;
    4: all listings; 5: the default, only when nothing is listed at all.
    """
    price = F.col(PRICE).cast("double")
    narrow = [*PLACE, "category"]
    tier1 = similar_stats(subjects, listings, narrow)
    # City and overall means are built from the place totals, so the listings are read once for all
    # three; stored, their size decides whether they are broadcast to the subjects.
    totals = listings.groupBy(*PLACE).agg(F.count(price).alias("n"), F.sum(price).alias("amount"))
    totals = stored(totals, "place-totals")
    mean = F.sum("amount") / F.sum("n")
    in_place = present(totals, PLACE).select(*PLACE, F.col("n").alias("n2"), (F.col("amount") / F.col("n")).alias("mean2"))
    in_city = totals.filter(F.col("city_province").isNotNull()).groupBy("city_province")
    in_city = in_city.agg(F.sum("n").alias("n3"), mean.alias("mean3"))
    overall = totals.agg(mean).scalar()
    tier = (
        F.when(F.col("n_similar") >= enough, 1).when(F.col("n2") >= enough, 2).when(F.col("n3") > 0, 3)
        .when(F.col("mean4").isNotNull(), 4).otherwise(5)
    )
    value = (
        F.when(F.col("tier") == 1, F.col("avg_similar")).when(F.col("tier") == 2, F.col("mean2"))
        .when(F.col("tier") == 3, F.col("mean3")).when(F.col("tier") == 4, F.col("mean4")).otherwise(F.lit(default))
    )
    return (
        _with_area(subjects)
        .select(subject_key, *narrow, "area")
        .join(tier1, [*narrow, "area"], "left")
        .join(in_place, list(PLACE), "left")
        .join(in_city, "city_province", "left")
        .withColumn("mean4", overall)
        .withColumn("tier", tier)
        .select(subject_key, "tier", value.alias("estimate"))
    )

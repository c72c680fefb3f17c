"""Exact quantiles per group without gathering a group.

The ranks are located in two passes. Pass one counts rows per group and logarithmic bin, pass two
counts distinct values inside the few bins that hold a wanted rank. Both shuffles carry
pre-aggregated counts, so neither a hot group nor a large table ends up in one task: a 32-bit float
column has some thousand bins per group and at most about 2**15 distinct values per bin.
Columns of doubles get further passes that cut the chosen bins into linear slices.
"""

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelframe.session import stored

# Bins per e-fold of the absolute value, and an offset that keeps every finite double's bin above zero.
_BINS_PER_EFOLD = 512
_BIN_OFFSET = 400_000
_SLICES = 4096


def _log_bin(value: Column) -> Column:
    """An integer that never falls as the value rises."""
    finite = F.least(F.abs(value), F.lit(sys.float_info.max))
    size = F.floor(F.ln(finite) * _BINS_PER_EFOLD) + _BIN_OFFSET
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("bigint") * size)


def _slice_bin(value: Column) -> Column:
    span = F.col("_top") - F.col("_low")
    part = F.when(span > 0, F.floor((value - F.col("_low")) / span * (_SLICES - 1))).otherwise(F.lit(0))
    return F.col("_bin") * _SLICES + part


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float | str], keys: Sequence[str] = (), refinements: int | None = None
) -> DataFrame:
    """One row per group with a column per named probability, linearly interpolated.

    In place of a probability a text may give the place itself, counted from 0, as an expression of the group's count ``_total``;
    a place beyond the last row is null, and a keyed group with no other place has no row.

    Null values and groups with a null key are ignored. Without keys there is exactly one row, with
    nulls when nothing was counted. Values are worked with as doubles: integers beyond 2**53 and decimals of more
    than 15 digits are rounded to the nearest one.
    """
    kind = df.schema[value].dataType
    if refinements is None:
        refinements = 2 if isinstance(kind, T.DoubleType | T.DecimalType | T.LongType) else 0
    keys = list(keys)
    by = keys or ["_all"]
    rows = df.select(*[F.col(k) for k in keys], F.col(value).cast("double").alias("_value"))
    if not keys:
        rows = rows.withColumn("_all", F.lit(0))
    rows = rows.dropna(subset=[*by, "_value"]).withColumn("_bin", _log_bin(F.col("_value")))

    # Without keys there are at most two bins per probability. With keys the number of groups is open,
    # so the bins are stored and their size decides how they are joined; the rows are not shuffled
    # on the chance that they might be many.
    place = (lambda bins: stored(bins, "quantile-bins")) if keys else F.broadcast
    wanted = place(_wanted_bins(_counted(rows, by), by, probs.values()))
    for _ in range(refinements):
        rows = (
            rows.join(wanted, [*by, "_bin"])
            .withColumn("_bin", _slice_bin(F.col("_value")))
            .withColumn("_parent", F.floor(F.col("_bin") / _SLICES))
        )
        wanted = place(_narrowed(_counted(rows, by, "_parent", "_before", "_ranks"), by))
        rows = rows.select(*by, "_value", "_bin")
    values = (
        rows.join(wanted.select(*by, "_bin", "_before", "_ranks"), [*by, "_bin"])
        .groupBy(*by, "_bin", "_before", "_ranks", "_value")
        .agg(F.count("*").alias("_count"))
    )
    inside = Window.partitionBy(*by, "_bin").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        values.withColumn("_end", F.col("_before") + F.sum("_count").over(inside))
        .withColumn("_rank", F.explode(F.expr(_RANKS_HERE)))
        .withColumns({"_is_low": F.expr(_HERE.format("_rank.low")), "_is_high": F.expr(_HERE.format("_rank.high"))})
    )
    columns = [F.expr(_INTERPOLATED.format(slot=slot)).alias(name) for slot, name in enumerate(probs)]
    return found.groupBy(*keys).agg(*columns)


# A wanted rank, counted from 0, falls on the _count rows that end before row _end.
_HERE = "{0} >= _end - _count AND {0} < _end"
_RANKS_HERE = f"filter(_ranks, r -> ({_HERE.format('r.low')}) OR ({_HERE.format('r.high')}))"
_LOW = "max(IF(_rank.slot = {slot} AND _is_low, _value, NULL))"
_HIGH = "max(IF(_rank.slot = {slot} AND _is_high, _value, NULL))"
_WEIGHT = "max(IF(_rank.slot = {slot}, _rank.weight, NULL))"
_INTERPOLATED = f"{_LOW} + IF({_WEIGHT} > 0, {_WEIGHT} * ({_HIGH} - {_LOW}), 0D)"


def _counted(rows: DataFrame, by, *extra) -> DataFrame:
    return rows.groupBy(*by, "_bin", *extra).agg(
        F.count("*").alias("_count"), F.min("_value").alias("_low"), F.max("_value").alias("_top")
    )


def _place(prob: float | str) -> str:
    return f"cast({prob} as double)" if isinstance(prob, str) else f"{float(prob)!r}D * (_total - 1)"


def _wanted_bins(counted: DataFrame, by, probs) -> DataFrame:
    """Bins that hold a wanted rank, with the rows before them and the ranks themselves."""
    group = Window.partitionBy(*by)
    upto = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    places = ", ".join(f"named_struct('slot', {i}, 'at', {_place(p)})" for i, p in enumerate(probs))
    ranks = F.expr(
        f"transform(array({places}), p -> named_struct('slot', p.slot, 'low', floor(p.at), 'high', ceil(p.at), "
        "'weight', p.at - floor(p.at)))"
    )
    placed = counted.withColumns({"_total": F.sum("_count").over(group), "_end": F.sum("_count").over(upto)})
    return _holding(placed.withColumn("_ranks", ranks), by)


def _narrowed(counted: DataFrame, by) -> DataFrame:
    upto = Window.partitionBy(*by, "_parent").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    return _holding(counted.withColumn("_end", F.col("_before") + F.sum("_count").over(upto)), by)


def _holding(placed: DataFrame, by) -> DataFrame:
    return (
        placed.withColumns({"_ranks": F.expr(_RANKS_HERE), "_before": F.col("_end") - F.col("_count")})
        .filter(F.size("_ranks") > 0)
        .select(*by, "_bin", "_low", "_top", "_before", "_ranks")
    )


def quantile_values(df: DataFrame, value: str, probs: Mapping[str, float]) -> dict[str, float | None]:
    """The quantiles of a whole column as plain numbers, so that filters on them reach the scan.

    Runs a job over that one column; a handful of numbers reach the driver.
    """
    return exact_quantiles(df, value, probs).first().asDict()


def column_quantile(df: DataFrame, columns: Sequence[str], prob: float, missing: float | None = None) -> dict[str, float | None]:
    """One quantile of several columns, nulls and a missing sentinel left out.

    All columns go through one job as doubles, which hold every 32-bit value; refinements are made only if some
    column has more than 32 bits. Integers are exact up to 2**53.
    """
    named = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(F.inline(F.array(*named)))
    if missing is not None:
        long = long.filter(F.col("value") != missing)
    narrow = T.FloatType | T.IntegerType | T.ShortType | T.ByteType
    refinements = 0 if all(isinstance(df.schema[c].dataType, narrow) for c in columns) else 2
    rows = exact_quantiles(long, "value", {"found": prob}, keys=["column"], refinements=refinements).collect()
    found = {row["column"]: row["found"] for row in rows}
    return {c: found.get(c) for c in columns}


def exact_medians(df: DataFrame, columns: Sequence[str], missing: float = -1) -> dict[str, float | None]:
    """The exact median of each column, the missing sentinel, nulls and NaN left out."""
    numbers = {c: F.nanvl(F.col(c), F.lit(None)) for c in columns if isinstance(df.schema[c].dataType, T.FloatType | T.DoubleType)}
    return column_quantile(df.withColumns(numbers) if numbers else df, columns, 0.5, missing)


def approx_medians(df: DataFrame, columns: Sequence[str], missing: float = -1, error: float = 0.01) -> dict[str, float]:
    """Approximate medians, the missing sentinel left out, all columns in one job."""
    known = df.select(*[F.nullif(F.col(c), F.lit(missing).cast(df.schema[c].dataType)).alias(c) for c in columns])
    found = known.approxQuantile(list(columns), [0.5], error)
    return {c: (values[0] if values else None) for c, values in zip(columns, found, strict=True)}


def _decimal(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"decimal(38,{kind.scale})"
    if isinstance(kind, T.IntegralType):
        return "decimal(38,0)"
    raise TypeError(f"whole numbers or decimals are needed, not {kind.simpleString()}")


def exact_decimal_quantiles(df: DataFrame, value: str, probs: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per group with ``name``, ``name_low`` and ``name_high`` for each probability, of whole numbers or decimals.

    No digit is lost: ``low`` and ``high`` are the values on either side of the wanted place, ``name`` lies between them in
    proportion, rounded to two digits more than the values have. Probabilities are texts or whole numbers, so that 0.1 is a tenth.
    Groups are never gathered. The range that holds a wanted rank is cut into slices again and again, each time between the least
    and the largest value in it, and only counts of slices are shuffled; 4096 slices per range leave a 64-bit column
    with single values after six rounds at most. Only the slice of a value is worked out in doubles, which never turn the order around.
    Nulls and groups with a null key are left out; without keys there is one row, with nulls if nothing was counted. The
    difference of the largest and the least value must have 38 digits at most.
    """
    kind = _decimal(df.schema[value].dataType)
    scale = int(kind[:-1].split(",")[1])
    keys = list(keys)
    by = keys or ["_all"]
    rows = df.select(*[F.col(k) for k in keys], F.col(value).cast(kind).alias("_value")).withColumn("_all", F.lit(0))
    rows = rows.dropna(subset=[*by, "_value"]).select(*by, "_value")
    names = list(probs)
    place = lambda p: f"cast('{p}' as decimal(10,9)) * cast(_total - 1 as decimal(20,0))"
    ranks = ", ".join(f"{f}({place(p)})" for p in probs.values() for f in ("floor", "ceil"))
    limits = rows.groupBy(*by).agg(F.count("*").alias("_total"), F.min("_value").alias("_low"), F.max("_value").alias("_top"))
    totals = limits = stored(limits, "decimal-limits")
    ranges = limits.select(*by, "_low", "_top", F.lit(0).cast("bigint").alias("_before"), F.expr(f"array_distinct(transform(array({ranks}), r -> cast(r as bigint)))").alias("_ranks"))
    done = []
    while True:
        done.append(ranges.filter("_low = _top").select(*by, F.col("_low").alias("_value"), F.explode("_ranks").alias("_rank")))
        wide = stored(ranges.filter("_low < _top"), "decimal-ranges")
        if wide.isEmpty():
            break
        inside = rows.join(wide.withColumnsRenamed({"_low": "_from", "_top": "_to"}), by).filter("_value >= _from and _value <= _to")
        part = F.col("_value") - F.col("_from")
        share = part.cast("double") / (F.col("_to") - F.col("_from")).cast("double")
        bin_ = F.least(F.floor(share * _SLICES), F.lit(_SLICES - 1)).alias("_bin")
        counted = inside.groupBy(*by, "_from", "_before", "_ranks", bin_).agg(F.count("*").alias("_count"), F.min("_value").alias("_low"), F.max("_value").alias("_top"))
        upto = Window.partitionBy(*by, "_from").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
        placed = counted.withColumn("_end", F.col("_before") + F.sum("_count").over(upto)).withColumn("_start", F.col("_end") - F.col("_count"))
        placed = placed.withColumn("_ranks", F.expr("filter(_ranks, r -> r >= _start and r < _end)")).filter(F.size("_ranks") > 0)
        ranges = stored(placed.select(*by, "_low", "_top", F.col("_start").alias("_before"), "_ranks"), "decimal-ranges")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    values = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    joined = totals.join(values, by)
    if not keys:
        joined = df.sparkSession.range(1).select(F.lit(0).alias("_all")).join(joined, "_all", "left")
    columns = []
    for name in names:
        low, high = (f"_at[cast({f}({place(probs[name])}) as bigint)]" for f in ("floor", "ceil"))
        weight = f"cast({place(probs[name])} - floor({place(probs[name])}) as decimal(10,9))"
        between = f"cast({low} + cast(({high} - {low}) * {weight} as decimal(38,{scale + 2})) as decimal(38,{scale + 2}))"
        columns += [F.expr(between).alias(name), F.expr(low).alias(f"{name}_low"), F.expr(high).alias(f"{name}_high")]
    return joined.select(*keys, *columns)

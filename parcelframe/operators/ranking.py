"""Ordering, top-k, sampling and splitting."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k_groups(groups: DataFrame, by: str, key: str, k: int = 10) -> DataFrame:
    """The k highest groups, ties by key."""
    return groups.orderBy(F.desc(by), key).limit(k)


def keep_top_groups(df: DataFrame, groups: DataFrame, by: str, key: str, k: int = 10) -> DataFrame:
    """Rows whose key is among the k highest groups; those k keys are broadcast."""
    return df.join(F.broadcast(top_k_groups(groups, by, key, k).select(key)), key, "left_semi")


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)


def numeric_order_of_text(df: DataFrame, column: str) -> DataFrame:
    """Rows in the numeric order of a text column."""
    return df.orderBy(F.col(column).try_cast("double"))


def head_n(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def _mixed(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def _hash_prefix(key: str) -> Column:
    """The first 32 bits of the key's hash as a number."""
    return F.conv(F.substring(_mixed(key), 1, 8), 16, 10).cast("bigint")


def sample_n(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """n rows that depend only on their keys, or all rows when there are fewer.

    The rows are those with the lowest hashes. Counts by the first hash bits (65,536 of them at most) tell how low,
    so that about n rows, and not n of every partition, are ordered in the end.
    """
    counts = df.groupBy(F.shiftright(_hash_prefix(key), 16).alias("bucket")).count()
    total, cut = 0, None
    for row in counts.orderBy(F.col("bucket").asc_nulls_first()).toLocalIterator():
        total, cut = total + row["count"], row["bucket"]
        if total >= n:
            break
    low = F.shiftright(_hash_prefix(key), 16)
    few = df if cut is None else df.filter(low.isNull() | (low <= cut))
    return few.orderBy(_mixed(key), key).limit(n)


def in_train(key: str, train_share: float = 0.8) -> Column:
    """A stable assignment to the training part, spread by the hash of a key; rows without a key are not in it."""
    return F.coalesce(_hash_prefix(key) < round(train_share * 2**32), F.lit(False))


def train_test_split(
    df: DataFrame, key: str | None = None, train_share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """By the hash of a key, so that a recomputed partition cannot move a row; at random without one.

    Every row is in one part: those with a null key are test rows.
    """
    if key is None:
        train, test = df.randomSplit([train_share, 1 - train_share], seed=seed)
        return train, test
    chosen = in_train(key, train_share)
    return df.filter(chosen), df.filter(~chosen)

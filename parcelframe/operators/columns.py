"""Projection, null handling and schema lookup."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelframe import fixed


def drop_columns(df: DataFrame, columns: Iterable[str] = ("link", "title")) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Tolerant casts; a value that does not fit becomes null."""
    return df.withColumns({name: F.col(f"`{name}`").try_cast(kind) for name, kind in types.items()})


def dropna_subset(df: DataFrame, columns: Iterable[str] = ("price", "area")) -> DataFrame:
    return df.dropna(subset=list(columns))


def present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows without a null in the columns, as conditions that the scan understands."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def fill_numeric_sentinel(df: DataFrame, columns: Iterable[str] = fixed.COUNT_COLUMNS) -> DataFrame:
    """Null becomes -1; the columns keep their type, text included."""
    kinds = {f.name: f.dataType for f in df.schema}
    sentinel = F.lit(fixed.MISSING_NUMBER)
    return df.withColumns({c: F.coalesce(F.col(c), sentinel.cast(kinds[c])) for c in columns})


def fill_categorical_unknown(df: DataFrame, columns: Iterable[str] = fixed.LABEL_COLUMNS) -> DataFrame:
    return df.fillna(fixed.UNKNOWN_LABEL, subset=list(columns))


def alias_columns(df: DataFrame, aliases: Mapping[str, str] = fixed.COLUMN_ALIASES) -> DataFrame:
    """Keep both spellings of a column wherever one of them exists."""
    present = set(df.columns)
    added = {}
    for old, new in aliases.items():
        if old in present:
            added[new] = F.col(f"`{old}`")
        elif new in present:
            added[old] = F.col(f"`{new}`")
    return df.withColumns(added) if added else df


def numeric_columns(df: DataFrame, first: int | None = None) -> list[str]:
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return names[:first]


def resolve_column(df: DataFrame, candidates: Iterable[str], numeric_fallback: bool = False, other_than=()) -> str:
    """First candidate that exists, else the first numeric column on request, else the first column."""
    names = [name for name in df.columns if name not in other_than]
    for name in candidates:
        if name in names:
            return name
    if numeric_fallback:
        for name in numeric_columns(df):
            if name in names:
                return name
    if not names:
        raise ValueError("the table has no column to fall back on")
    return names[0]


def preview(df: DataFrame, columns: Iterable[str], order_by: Iterable[str], n: int = 10) -> DataFrame:
    """First n rows of some columns in a total order."""
    return df.orderBy(*order_by).limit(n).select(*columns)


def missing_flags(df: DataFrame, columns: Iterable[str] = fixed.NUMERIC_FEATURES) -> DataFrame:
    """``<c>_missing_flag`` is 1 where c is -1 and 0 elsewhere, null included."""
    return df.withColumns(
        {f"{c}_missing_flag": F.when(F.col(c) == fixed.MISSING_NUMBER, 1).otherwise(0) for c in columns}
    )


def add_placeholders(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns that a trained pipeline expects and the table lacks."""
    absent = {name: F.lit(value) for name, value in values.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df

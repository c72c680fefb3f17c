"""Price arithmetic, amount texts and small numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelframe import fixed


def price_per_m2(price: Column, area: Column) -> Column:
    return F.when(area > 0, price / area)


def log_price(price: Column) -> Column:
    return F.log1p(price)


def unlog_price(value: Column) -> Column:
    return F.expm1(value)


def total_price(unit_price: Column, area: Column) -> Column:
    """Whole VND; both the unit price and the product are rounded half to even."""
    return F.bround(F.bround(unit_price) * area).cast("bigint")


def in_billions(amount: Column) -> Column:
    return amount / F.lit(1e9)


def format_thousands(value: Column, decimals: int = 0) -> Column:
    """Grouped number text such as 12,345."""
    return F.format_number(value, decimals)


def format_plain(value: Column, decimals: int = 1) -> Column:
    """Number text without grouping, rounded half to even."""
    return F.replace(F.format_number(value, decimals), F.lit(","), F.lit(""))


def format_price(amount: Column) -> Column:
    """Whole VND as text in its two largest adjoining units; a zero second part is left out."""
    grouped = lambda value: F.format_number(value, 0)
    text = F.concat_ws(" ", grouped(amount), F.lit(fixed.CURRENCY))
    units = fixed.AMOUNT_UNITS
    for i in reversed(range(len(units))):
        word, size = units[i]
        parts = [grouped(F.floor(amount / size)), F.lit(word)]
        if i + 1 < len(units):
            small_word, small_size = units[i + 1]
            rest = F.floor((amount % size) / small_size)
            parts.append(F.when(rest > 0, F.concat_ws(" ", grouped(rest), F.lit(small_word))))
        text = F.when(amount >= size, F.concat_ws(" ", *parts, F.lit(fixed.CURRENCY))).otherwise(text)
    return F.when(amount.isNotNull(), text)


def share_of_total(part: Column, total: Column) -> Column:
    """Whole percent, truncated; 0 when there is nothing to share."""
    return F.when(total > 0, F.floor(part / total * 100)).otherwise(F.lit(0)).cast("bigint")


def positive_size(value: Column) -> Column:
    """A marker size of at least 1."""
    return F.greatest(F.lit(1), F.coalesce(value, F.lit(1)))


def posting_month(posted: Column, pattern: str = "dd/MM/yyyy") -> Column:
    """Month of the year of a date text; null where the text is no date."""
    return F.month(F.try_to_timestamp(posted, F.lit(pattern)))

"""Column expressions that turn listing texts into numbers and places.

Every parser tolerates malformed text: it yields null instead of failing, also with ANSI mode on.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelframe import fixed

_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def _without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def _decimal_comma(text: Column) -> Column:
    return F.translate(text, ",", ".").try_cast("double")


def _thousands_comma(text: Column) -> Column:
    return _without(text, ",").try_cast("double")


def _first_unit(text: Column, units, amount, otherwise: Column) -> Column:
    """The amount in the first unit whose word occurs in the text, else ``otherwise``."""
    return reduce(
        lambda rest, unit: F.when(text.contains(unit[0]), amount(unit[0]) * unit[1]).otherwise(rest),
        reversed(units),
        otherwise,
    )


def whole_number(text: Column) -> Column:
    """Plain decimal text as an int, fraction dropped; anything else is null."""
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double").try_cast("int"))


def clean_location(location: Column) -> Column:
    return F.regexp_replace(location, fixed.SAVE_MARKER, "")


def location_parts(location: Column) -> tuple[Column, Column]:
    """(district, city) from the last two comma-separated parts of a location."""
    parts = F.split(clean_location(location), ",")
    return F.trim(F.try_element_at(parts, F.lit(-2))), F.trim(F.try_element_at(parts, F.lit(-1)))


def parse_price_total(price: Column) -> Column:
    """Total price in VND. A comma is a decimal mark beside a unit word, else it groups thousands."""
    plain = F.when(~price.contains(fixed.NEGOTIABLE), _thousands_comma(price))
    return _first_unit(
        price, fixed.TOTAL_PRICE_UNITS, lambda word: _decimal_comma(_without(price, word)), plain
    ).cast("float")


def parse_price_unit(price: Column) -> Column:
    """Price per square metre in VND; beside a unit word only digits and commas count."""
    text = F.regexp_replace(_without(price, fixed.APPROX_MARK), fixed.UNIT_PRICE_SUFFIX, "")
    digits = _decimal_comma(F.regexp_replace(text, "[^0-9,]", ""))
    return _first_unit(text, fixed.UNIT_PRICE_UNITS, lambda _: digits, _thousands_comma(text)).cast("float")


def parse_area(area: Column) -> Column:
    return F.regexp_replace(area, fixed.AREA_SUFFIX, "").try_cast("float")


def parse_floor(floor: Column) -> Column:
    return whole_number(F.regexp_replace(floor, fixed.FLOOR_SUFFIX, ""))


def parse_bedroom(bedroom: Column) -> Column:
    return whole_number(F.regexp_replace(bedroom, fixed.BEDROOM_SUFFIX, ""))


def parse_street_width(street: Column) -> Column:
    """Width in metres, the middle of a range "a-b"; -1 where nothing can be read."""
    ends = F.split(_without(street, "m"), "-")
    first, second = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
    middle = (first.try_cast("float") + second.try_cast("float")) / 2
    width = F.when(second.isNull(), first.try_cast("float")).otherwise(middle)
    return F.coalesce(width, F.lit(float(fixed.MISSING_NUMBER))).cast("float")


def split_multivalue(text: Column, mark: str = "|") -> Column:
    """A marked list as an array; empty text is the empty array."""
    values = F.split(text, f"[{mark}]")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(values)


def join_multivalue(values: Column, mark: str = "|") -> Column:
    return F.array_join(values, mark)


def blank_to_null(text: Column) -> Column:
    """What a CSV round trip does to blank fields."""
    return F.nullif(F.trim(text), F.lit(""))

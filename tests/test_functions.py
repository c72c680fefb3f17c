"""Golden rows of the text parsers and number functions, with ANSI mode on."""

import pytest
from pyspark.sql import functions as F

from parcelframe.functions import numbers, text

GOLDEN = {
    "price_total": (
        lambda c: text.parse_price_total(c),
        {
            "1,5 tỷ": 1.5e9, "800 triệu": 8e8, "Thương lượng": None, "2 tỷ 500 triệu": None, "2 tỷ 50 triệu": None,
            "12,5 triệu/m2": None, "~12,5 triệu/m2": None, "950 nghìn": None, "1,200,000": 1.2e6, "2 TỶ": None,
            "": None, None: None,
        },
    ),
    "price_unit": (
        lambda c: text.parse_price_unit(c),
        {
            "1,5 tỷ": None, "800 triệu": 8e8, "Thương lượng": None, "2 tỷ 500 triệu": 2.5e9, "2 tỷ 50 triệu": 2.5e8,
            "12,5 triệu/m2": 1.25e7, "~12,5 triệu/m2": 1.25e7, "950 nghìn": 9.5e5, "1,200,000": 1.2e6, "2 TỶ": None,
            "": None, None: None,
        },
    ),
    "street": (
        lambda c: text.parse_street_width(c),
        {
            "6-8m": 7.0, "12m - 15m": 13.5, "5m": 5.0, "8": 8.0, "4-6-9m": 5.0, "m": -1.0, "-": -1.0, "": -1.0,
            None: -1.0, "3,5m": -1.0,
        },
    ),
    "area": (
        lambda c: text.parse_area(c),
        {"100 m2": 100.0, "1.200 m2": pytest.approx(1.2), "55,5 m2": None, "0 m2": 0.0, "m2": None, "70": 70.0, None: None},
    ),
    "floor": (
        lambda c: text.parse_floor(c),
        {"2 tầng": 2, "3": 3, "x tầng": None, "-1": -1, "2.7": 2, "1e3": None, "99999999999": None, None: None},
    ),
    "bedroom": (lambda c: text.parse_bedroom(c), {"4 phòng": 4, "phòng": None, " 5 ": 5}),
    "location": (
        lambda c: F.concat_ws("|", *[F.coalesce(p, F.lit("<null>")) for p in text.location_parts(c)]),
        {"Q1, HCM Lưu tin": "Q1|HCM", "A, B, C": "B|C", "HCM": "<null>|HCM", "": "<null>|", "Không xác định": "<null>|Không xác định"},
    ),
    "multivalue": (
        lambda c: F.size(text.split_multivalue(c)),
        {"": 0, "garage": 1, "garage|garden": 2, "a||b": 3},
    ),
    "blank": (lambda c: text.blank_to_null(c), {"": None, "  ": None, "a": "a", None: None}),
    "amount": (
        lambda c: numbers.format_price(c.cast("bigint")),
        {
            "2500000000": "2 tỷ 500 triệu VND", "2000000000": "2 tỷ VND", "2000999999": "2 tỷ VND", "1500000": "1 triệu 500 nghìn VND",
            "1000999": "1 triệu VND", "999999": "999 nghìn VND", "1500": "1 nghìn VND", "999": "999 VND", "0": "0 VND",
            "1234000000000": "1,234 tỷ VND", None: None,
        },
    ),
    "thousands": (lambda c: numbers.format_thousands(c.cast("double")), {"1234567.5": "1,234,568", "0.5": "0", "1.5": "2"}),
    "plain": (lambda c: numbers.format_plain(c.cast("double")), {"1234.25": "1234.2", "0.35": "0.3", "0.75": "0.8"}),
    "size": (lambda c: numbers.positive_size(c.cast("int")), {"-1": 1, "0": 1, "3": 3, None: 1}),
    "month": (lambda c: numbers.posting_month(c), {"05/12/2020": 12, "2020-12-05": None, "": None, None: None}),
    "total": (lambda c: numbers.total_price(c.cast("double"), F.lit(2.5)), {"2.5": 5, "3.5": 10, "1.0": 2}),
    "share": (lambda c: numbers.share_of_total(c.cast("int"), F.lit(3)), {"2": 66, "0": 0, "3": 100}),
}


@pytest.mark.parametrize("name", GOLDEN)
def test_golden_rows(spark, name):
    expression, golden = GOLDEN[name]
    rows = spark.createDataFrame([(k,) for k in golden], "x string").select("x", expression(F.col("x")).alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == golden


def test_share_of_nothing(spark):
    assert spark.range(1).select(numbers.share_of_total(F.lit(0), F.lit(0))).first()[0] == 0


def test_price_per_m2_needs_an_area(spark):
    rows = spark.createDataFrame([(6.0, 2.0), (6.0, 0.0), (6.0, None)], "p double, a double")
    assert [r[0] for r in rows.select(numbers.price_per_m2(F.col("p"), F.col("a"))).collect()] == [3.0, None, None]

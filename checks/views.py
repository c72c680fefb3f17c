"""Listing tables derived from the given star-schema tables, in Spark and in SQL.

Every row of ``orders`` becomes a listing, every row of ``lineitem`` one stored detail page and one
status event. FIXTURES.md lists the rules. ``k`` is the order key.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelframe import schemas
from parcelframe.plans.cleaning import clean_listings_a, clean_listings_b, prepare_model_frame

# Cell rules that read the same in both engines; the first matching branch wins.
_RAW_RULES = {
    "listing_id": "o_orderkey",
    "link": "concat('http://listing/', o_orderkey)",
    "title": "o_orderpriority",
    "location": "CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN r_name "
    "WHEN o_orderkey % 3 = 0 THEN concat(n_name, ', ', r_name, ' Lưu tin') "
    "ELSE concat('so 1, ', n_name, ', ', r_name) END",
    "price": "CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'Thương lượng' "
    "WHEN o_orderkey % 13 = 0 THEN '2 tỷ 500 triệu' "
    "WHEN o_orderkey % 4 = 0 THEN concat(1 + o_orderkey % 9, ',', o_orderkey % 10, ' tỷ') "
    "WHEN o_orderkey % 4 = 1 THEN concat(300 + o_orderkey % 700, ' triệu') "
    "WHEN o_orderkey % 4 = 2 THEN concat(1 + o_orderkey % 9, ',', 100 + o_orderkey % 900, ',000,000') "
    "ELSE concat('~', 5 + o_orderkey % 60, ',', o_orderkey % 10, ' triệu/m2') END",
    "area": "CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN '0 m2' "
    "WHEN o_orderkey % 67 = 0 THEN '55,5 m2' ELSE concat(20 + o_orderkey % 181, ' m2') END",
    "category": "c_mktsegment",
    "direction": "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'Đông' ELSE 'Tây Nam' END",
    "floor_num": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat(1 + o_orderkey % 6, ' tầng') END",
    "toilet_num": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat(1 + o_orderkey % 4, '') END",
    "street": "CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN '-' "
    "WHEN o_orderkey % 4 = 0 THEN concat(2 + o_orderkey % 5, 'm - ', 8 + o_orderkey % 5, 'm') "
    "ELSE concat(3 + o_orderkey % 12, 'm') END",
    "livingroom_num": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat(1 + o_orderkey % 2, '') END",
    "bedroom_num": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE concat(1 + o_orderkey % 5, ' phòng') END",
    "liability": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END",
    "posting_ts": "o_orderdate",
}

_DETAIL_RULES = {
    "url": "concat('http://listing/', l_orderkey)",
    "description": "concat('desc ', l_returnflag, l_linestatus)",
    "posting_date": None,
    "contact_name": "concat('owner ', l_suppkey)",
    "contact_phone": "CASE WHEN l_tax = 0 THEN NULL ELSE concat('09', 10000000 + l_suppkey) END",
    "features": "CASE WHEN l_discount = 0 THEN '' WHEN l_linestatus = 'O' THEN 'garage' ELSE 'garage|garden|pool' END",
    "image_urls": "concat('img', l_partkey % 3, '.jpg|img9.jpg')",
    "ts": "l_shipdate",
    "seq": "l_linenumber",
    "part": "l_partkey",
}

_STATUS_RULES = {
    "link": "concat('http://listing/', l_orderkey)",
    "status": "CASE l_returnflag WHEN 'A' THEN 'error' WHEN 'R' THEN 'failed' ELSE 'processed' END",
    "ts": "l_shipdate",
    "seq": "l_linenumber",
    "part": "l_partkey",
}

# A stored listing page and a stored detail page; a null field leaves its element out.
_PAGE_RULES = {
    "listing_id": "listing_id",
    # With what a page may hold besides: comments, stray marks outside of their parents, upper case and single quotes.
    "html": "concat('<html><body><!-- <h1 class=\"head-title\">old</h1> --><div class=\"infor-note\">stray</div>', "
    "'<div class=\"opt opt-duong\"><p><span class=\"value-item\">deep</span></p></div><H1 CLASS=\\'big head-title\\'>', title, '</H1>', "
    "coalesce(concat('<div style=\"float:left; width:87%; padding-left: 5px;\">', location, '</div>'), ''), "
    "'<div class=\"col-item\"><div class=\"infor-note\">a</div><div class=\"infor-data\">b</div></div>', "
    "'<div class=\"col-item\">', coalesce(concat('<div class=\"infor-note\"><b>', price, '</b></div>'), ''), "
    "coalesce(concat('<div class=\"infor-data\">', area, '</div>'), ''), '</div>', "
    + ", ".join(
        f"coalesce(concat('<div class=\"opt {mark}\"><div>x</div><span class=\"value-item\">', {name}, '</span></div>'), '')"
        for name, mark in (
            ("category", "opt-mattien"), ("direction", "opt-huongnha"), ("floor_num", "opt-sotang"),
            ("toilet_num", "opt-sotoilet"), ("street", "opt-duong"), ("livingroom_num", "opt-bancong"),
            ("bedroom_num", "opt-sopngu"), ("liability", "opt-phaply"),
        )
    )
    + ", '</body></html>')",
}

_DETAIL_PAGE_RULES = {
    "url": "url",
    "ts": "ts",
    "seq": "seq",
    "part": "part",
    "html": "concat('<html><body><!-- <div class=\"posting-date\">old</div> --><div class=\"features\"><p><li>stray</li></p></div>', "
    "'<DIV class=\\'description-content\\'><div>', description, '</div> more &#38; more</DIV><div class=\"carousel\"><img src=\"logo.jpg\"></div>', "
    "'<div class=\"posting-date\">', posting_date, '</div><div class=\"contact-name\">', contact_name, '</div>', "
    "coalesce(concat('<div class=\"contact-phone\">', contact_phone, '</div>'), ''), '<div class=\"features\"><ul>', "
    "CASE WHEN features = '' THEN '' ELSE concat('<li>', replace(features, '|', '</li><li>'), '</li>') END, '</ul></div>', "
    "'<div class=\"carousel\"><div class=\"item\"><img src=\"', replace(image_urls, '|', '\"></div><div class=\"item\"><img src=\"'), "
    "'\"></div></div><div class=\"nearby-schools\"><div class=\"item\"><div class=\"name\">School ', seq, '</div>', "
    "'<div class=\"distance\">', seq, ' km</div></div><div class=\"item\"><div class=\"name\">Other</div>', "
    "'<div class=\"distance\">9 km</div></div></div></body></html>')",
}


def _columns(rules: dict) -> list[str]:
    return [f"{rule} AS {name}" for name, rule in rules.items()]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_from_orders(orders: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Listings of a batch or a stream of orders."""
    place = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return orders.join(place, F.col("o_custkey") == F.col("c_custkey")).selectExpr(*_columns(_RAW_RULES))


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return raw_from_orders(table(spark, folder, "orders"), spark, folder)


def raw_texts(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder).select(*schemas.LISTINGS_RAW.names)


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_listings_a(raw(spark, folder))


def clean_b(spark: SparkSession, folder: str) -> DataFrame:
    return clean_listings_b(raw(spark, folder))


def model_frame(spark: SparkSession, folder: str) -> DataFrame:
    return prepare_model_frame(clean(spark, folder))


def details(spark: SparkSession, folder: str) -> DataFrame:
    rules = {**_DETAIL_RULES, "posting_date": "date_format(l_shipdate, 'dd/MM/yyyy')"}
    return table(spark, folder, "lineitem").selectExpr(*_columns(rules))


def status_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*_columns(_STATUS_RULES))


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder).repartition("listing_id").selectExpr(*_columns(_PAGE_RULES))


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    return details(spark, folder).repartition("url").selectExpr(*_columns(_DETAIL_PAGE_RULES))


def widened(df: DataFrame) -> DataFrame:
    """Floats as doubles, so that both engines print the same values."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) if kinds[c] == "float" else F.col(f"`{c}`") for c in df.columns])


# --- the same views as SQL ---------------------------------------------------------------------

_RAW_SQL = (
    "raw AS (SELECT " + ", ".join(_columns(_RAW_RULES)) + " FROM orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)

_DETAILS_SQL = (
    "details AS (SELECT "
    + ", ".join(_columns({**_DETAIL_RULES, "posting_date": "strftime(l_shipdate, '%d/%m/%Y')"}))
    + " FROM lineitem)"
)

_STATUS_SQL = "status_log AS (SELECT " + ", ".join(_columns(_STATUS_RULES)) + " FROM lineitem)"

_NUMBER = "try_cast(trim({0}) AS DOUBLE)"
PRICE_A_SQL = (
    "CAST(CASE WHEN contains(price, 'tỷ') THEN "
    + _NUMBER.format("replace(replace(price, 'tỷ', ''), ',', '.')")
    + " * 1e9 WHEN contains(price, 'triệu') THEN "
    + _NUMBER.format("replace(replace(price, 'triệu', ''), ',', '.')")
    + " * 1e6 WHEN contains(price, 'Thương lượng') THEN NULL ELSE "
    + _NUMBER.format("replace(price, ',', '')")
    + " END AS REAL)"
)
_B_TEXT = "regexp_replace(replace(price, '~', ''), '\\s*/m2$', '')"
_B_DIGITS = _NUMBER.format(f"replace(regexp_replace({_B_TEXT}, '[^0-9,]', '', 'g'), ',', '.')")
PRICE_B_SQL = (
    f"CAST(CASE WHEN contains({_B_TEXT}, 'triệu') THEN {_B_DIGITS} * 1e6 WHEN contains({_B_TEXT}, 'nghìn') THEN "
    f"{_B_DIGITS} * 1e3 ELSE " + _NUMBER.format(f"replace({_B_TEXT}, ',', '')") + " END AS REAL)"
)
AREA_SQL = "try_cast(trim(regexp_replace(area, '\\s*m2$', '')) AS REAL)"
STREET_PARTS = "string_split(replace(street, 'm', ''), '-')"
STREET_SQL = (
    f"CAST(coalesce(CASE WHEN {STREET_PARTS}[2] IS NULL THEN try_cast(trim({STREET_PARTS}[1]) AS REAL) "
    f"ELSE (try_cast(trim({STREET_PARTS}[1]) AS REAL) + try_cast(trim({STREET_PARTS}[2]) AS REAL)) / 2 END, -1) AS REAL)"
)
LOCATION_SQL = "regexp_replace({0}, '\\s*Lưu tin\\s*$', '')"
_PARTS = "string_split(" + LOCATION_SQL.format("coalesce(location, 'Không xác định')") + ", ',')"
_TYPED = (
    "listing_id, category, coalesce(direction, 'Không xác định') AS direction, "
    "try_cast(regexp_replace(coalesce(floor_num, '-1'), '\\s*tầng$', '') AS INTEGER) AS floor_num, "
    "try_cast(coalesce(toilet_num, '-1') AS INTEGER) AS toilet_num, "
    "try_cast(coalesce(livingroom_num, '-1') AS INTEGER) AS livingroom_num, "
    "try_cast(regexp_replace(coalesce(bedroom_num, '-1'), '\\s*phòng$', '') AS INTEGER) AS bedroom_num, "
    "coalesce(liability, 'Không xác định') AS liability, posting_ts, "
    f"trim({_PARTS}[-2]) AS district, trim({_PARTS}[-1]) AS city_province"
)
# Floats are widened before any arithmetic; price over area divides doubles.
_CLEAN_SQL = (
    f"parsed AS (SELECT {_TYPED}, CAST({PRICE_A_SQL} AS DOUBLE) AS price, CAST({AREA_SQL} AS DOUBLE) AS area_m2, "
    f"CAST({STREET_SQL} AS DOUBLE) AS street_width_m FROM raw), "
    "clean AS (SELECT *, CAST(CAST(price / area_m2 AS REAL) AS DOUBLE) AS price_per_m2 FROM parsed "
    "WHERE price IS NOT NULL AND area_m2 > 0 AND price / area_m2 BETWEEN 2e6 AND 1e8)"
)
_CLEAN_B_SQL = (
    f"clean_b AS (SELECT {_TYPED}, CAST({PRICE_B_SQL} AS DOUBLE) AS price_per_m2, CAST({AREA_SQL} AS DOUBLE) AS area_m2, "
    f"CAST({STREET_SQL} AS DOUBLE) AS street_width_m FROM raw "
    f"WHERE price IS NOT NULL AND area IS NOT NULL AND {PRICE_B_SQL} IS NOT NULL)"
)
NUMERIC = ("area_m2", "floor_num", "toilet_num", "livingroom_num", "bedroom_num", "street_width_m")
_MODEL_SQL = (
    "medians AS (SELECT "
    + ", ".join(f"quantile_cont(CASE WHEN {c} <> -1 THEN CAST({c} AS DOUBLE) END, 0.5) AS m_{c}" for c in NUMERIC)
    + " FROM clean), model_frame AS (SELECT listing_id, category, direction, liability, district, city_province, price, "
    "price_per_m2, posting_ts, "
    + ", ".join(f"CASE WHEN {c} = -1 THEN 1 ELSE 0 END AS {c}_missing_flag" for c in NUMERIC)
    + ", "
    + ", ".join(f"CASE WHEN {c} = -1 THEN m_{c} ELSE CAST({c} AS DOUBLE) END AS {c}" for c in NUMERIC)
    + ", ln(1 + price_per_m2) AS price_log FROM clean, medians)"
)

_VIEWS = {
    "raw": (_RAW_SQL, ()),
    "clean": (_CLEAN_SQL, ("raw",)),
    "clean_b": (_CLEAN_B_SQL, ("raw",)),
    "model_frame": (_MODEL_SQL, ("clean",)),
    "details": (_DETAILS_SQL, ()),
    "status_log": (_STATUS_SQL, ()),
}


def with_views(select: str, *names: str, more: str = "") -> str:
    """A statement over the named views; ``more`` adds its own common table expressions."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _VIEWS[name][1]:
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    parts = [_VIEWS[name][0] for name in wanted] + ([more] if more else [])
    return (f"WITH {', '.join(parts)} " if parts else "") + select

"""Registered queries. Each takes (spark, folder) and returns a DataFrame; most have a SQL counterpart."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import views as v
from parcelframe import fixed, schemas
from parcelframe.functions import numbers, text
from parcelframe.operators import columns as cols
from parcelframe.operators import comparables, distributions, filters, quantiles, ranking, sketches, stats, worklist
from parcelframe.plans import cleaning, features, models, scoring
from parcelframe.session import stored, work_folder
from parcelframe.sources import listings, pages, sinks
from parcelframe.streaming import ingest

Query = Callable[..., DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

NUM = list(fixed.NUMERIC_FEATURES)
NUM7 = [*NUM, "price_per_m2"]
CLEAN_COLUMNS = "listing_id, price, area_m2, category, direction, floor_num, toilet_num, livingroom_num, bedroom_num, liability, district, city_province, street_width_m, price_per_m2"
RAW_COLUMNS = ", ".join(schemas.LISTINGS_RAW.names)


def query(name: str, sql: str | None = None, *needs: str, more: str = ""):
    """Registers a query; ``needs`` names the derived views its SQL reads."""

    def add(fn: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = v.with_views(sql, *needs, more=more)
        return fn

    return add


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


# --- sources -----------------------------------------------------------------------------------


@query("scan_listings_csv", f"SELECT {RAW_COLUMNS} FROM raw", "raw")
def _(spark, d):
    path = work_folder(spark, "listings-csv")
    sinks.write_table(v.raw_texts(spark, d), path)
    return listings.read_listings(spark, path)


@query("scan_clean", f"SELECT {CLEAN_COLUMNS.replace('listing_id, ', '')} FROM clean", "clean")
def _(spark, d):
    path = work_folder(spark, "clean")
    sinks.write_table(v.clean(spark, d).select(*schemas.LISTINGS_CLEAN.names), path, "parquet")
    return v.widened(listings.read_clean(spark, path))


@query("scan_storage", f"SELECT {RAW_COLUMNS} FROM raw", "raw")
def _(spark, d):
    path = work_folder(spark, "storage-csv")
    sinks.write_table(v.raw_texts(spark, d), path)
    return listings.read_storage(spark, path)


@query(
    "extract_listing_fields",
    "SELECT listing_id, "
    + ", ".join(
        # What a page shows: outer blanks trimmed, empty where the listing has no value.
        f"coalesce(trim({c}), '') AS {c}" for c in schemas.LISTINGS_RAW.names if c != "link"
    )
    + " FROM raw",
    "raw",
)
def _(spark, d):
    return pages.extract_fields(v.listing_pages(spark, d), keep=["listing_id"])


@query(
    "extract_page_fields",
    r"""SELECT page_id, trim(replace(regexp_extract(html, '<title>([^<]*)', 1), '&amp;', '&')) AS title,
    trim(replace(regexp_extract(html, '<h1>([^<]*)', 1), '&amp;', '&')) AS heading,
    regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS lang,
    trim(replace(regexp_extract(html, '<div class="ad">([^<]*)', 1), '&amp;', '&')) AS ad FROM pages""",
)
def _(spark, d):
    rules = {
        "title": pages.element_text("title"),
        "heading": pages.element_text("h1"),
        "lang": pages.pattern_text('<html[^>]*lang="([^"]*)"'),
        "ad": pages.element_text("div", pages.has_class("ad")),
    }
    return pages.extract_fields(v.table(spark, d, "pages"), rules=rules, keep=["page_id"])


@query(
    "extract_links",
    """SELECT page_id, url, CAST(i - 1 AS INTEGER) AS position, links[i] AS link FROM (
    SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS links FROM pages)
    CROSS JOIN LATERAL (SELECT unnest(range(1, len(links) + 1)) AS i)""",
)
def _(spark, d):
    return pages.extract_links(v.table(spark, d, "pages"), path=[("li", "")], keep=["page_id", "url"])


@query(
    "extract_details",
    """SELECT url, seq, part, concat(description, ' more & more') AS description, posting_date, contact_name,
    coalesce(contact_phone, '') AS contact_phone, features, image_urls FROM details""",
    "details",
)
def _(spark, d):
    found = pages.extract_details(v.detail_pages(spark, d), keep=["url", "seq", "part"])
    return found.withColumns({c: text.join_multivalue(F.col(c)) for c in ("features", "image_urls")})


@query(
    "extract_amenities",
    """SELECT url, part, 'schools' AS kind, name, distance FROM (
    SELECT url, part, concat('School ', seq) AS name, concat(seq, ' km') AS distance FROM details
    UNION ALL SELECT url, part, 'Other', '9 km' FROM details)""",
    "details",
)
def _(spark, d):
    found = pages.extract_amenities(v.detail_pages(spark, d), keep=["url", "part"])
    by_kind = found.select("url", "part", F.explode("nearby_amenities").alias("kind", "places"))
    return by_kind.select("url", "part", "kind", F.inline("places"))


@query("worklist_links", "SELECT link FROM raw", "raw")
def _(spark, d):
    return listings.worklist_links(v.raw(spark, d))


def _broken_csv(spark, d) -> str:
    """Listings as CSV lines, some cut short and some with further fields."""
    path = work_folder(spark, "broken-csv")
    raw = v.raw(spark, d)
    line, k = F.to_csv(F.struct(*schemas.LISTINGS_RAW.names), {"escape": '"'}), F.col("listing_id")
    line = F.when(k % 29 == 0, F.regexp_replace(line, ",[^,]*$", "")).when(k % 31 == 0, F.concat(line, F.lit(",more,1"))).otherwise(line)
    bare = {"header": "true", "quote": "", "sep": "\x01", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    raw.select(line.alias(",".join(schemas.LISTINGS_RAW.names))).write.options(**bare).csv(path)
    return path


@query(
    "read_checked",
    f"SELECT {RAW_COLUMNS} FROM raw WHERE listing_id % 29 <> 0 AND listing_id % 31 <> 0",
    "raw",
)
def _(spark, d):
    return listings.read_checked(spark, _broken_csv(spark, d))[0]


@query(
    "quarantined_lines",
    """SELECT link, CASE WHEN listing_id % 29 = 0 THEN 'too_few_fields' ELSE 'too_many_fields' END AS reason FROM raw
    WHERE listing_id % 29 = 0 OR listing_id % 31 = 0""",
    "raw",
)
def _(spark, d):
    bad = listings.read_checked(spark, _broken_csv(spark, d))[1]
    return bad.select(F.substring_index("line", ",", 1).alias("link"), "reason")


@query("write_single_csv", f"SELECT {RAW_COLUMNS} FROM raw", "raw")
def _(spark, d):
    path = work_folder(spark, "single") + ".csv"
    sinks.write_single_csv(v.raw_texts(spark, d), path)
    return listings.read_listings(spark, path)


@query(
    "replace_partitions",
    f"""SELECT {CLEAN_COLUMNS.replace('listing_id, ', '').replace('area_m2', "CASE WHEN city_province = 'ASIA' THEN area_m2 + 1 ELSE area_m2 END AS area_m2")} FROM clean""",
    "clean",
)
def _(spark, d):
    """All places are written, then one of them anew."""
    path = work_folder(spark, "by-city")
    clean = v.clean(spark, d).select(*schemas.LISTINGS_CLEAN.names)
    sinks.replace_partitions(clean, path, ["city_province"])
    changed = filters.filter_location(clean, "ASIA").withColumn("area_m2", (F.col("area_m2") + 1).cast("float"))
    sinks.replace_partitions(changed, path, ["city_province"])
    return v.widened(listings.read_clean(spark, path).select(*schemas.LISTINGS_CLEAN.names))


@query(
    "append_details",
    "SELECT url, description, posting_date, contact_name, contact_phone, features, image_urls FROM details UNION ALL "
    "SELECT url, description, posting_date, contact_name, contact_phone, features, image_urls FROM details WHERE features <> ''",
    "details",
)
def _(spark, d):
    path = work_folder(spark, "details")
    details = v.details(spark, d).select(*schemas.LISTING_DETAILS.names)
    sinks.append_details(details, path, "parquet")
    sinks.append_details(details.filter("features <> ''"), path, "parquet")
    return spark.read.parquet(path)


@query("read_inferred", "SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS status, o_orderdate AS ts FROM orders")
def _(spark, d):
    path = work_folder(spark, "inferred-csv")
    rows = v.table(spark, d, "orders").selectExpr("o_orderkey AS k", "o_totalprice AS price", "o_orderstatus AS status", "o_orderdate AS ts")
    sinks.write_table(rows, path)
    return listings.read_inferred(spark, path).withColumns(
        {"k": F.col("k").cast("bigint"), "ts": F.col("ts").cast("timestamp_ntz")}
    )


# --- projection and nulls ------------------------------------------------------------------------


@query("drop_columns", f"SELECT listing_id, posting_ts, {RAW_COLUMNS.replace('link, title, ', '')} FROM raw", "raw")
def _(spark, d):
    return cols.drop_columns(v.raw(spark, d))


@query("rename_columns", "SELECT listing_id, area AS area_m2, street AS street_width_m, price AS price_per_m2 FROM raw", "raw")
def _(spark, d):
    names = {"area": "area_m2", "street": "street_width_m", "price": "price_per_m2"}
    return cols.rename_columns(v.raw(spark, d).select("listing_id", "area", "street", "price"), names)


@query(
    "cast_types",
    """SELECT listing_id, try_cast(toilet_num AS INTEGER) AS toilet_num,
    try_cast(livingroom_num AS INTEGER) AS livingroom_num, try_cast(area AS DOUBLE) AS area FROM raw""",
    "raw",
)
def _(spark, d):
    kinds = {"toilet_num": "int", "livingroom_num": "int", "area": "double"}
    return cols.cast_types(v.raw(spark, d).select("listing_id", *kinds), kinds)


@query("dropna_subset", "SELECT listing_id, price, area FROM raw WHERE price IS NOT NULL AND area IS NOT NULL", "raw")
def _(spark, d):
    return cols.dropna_subset(v.raw(spark, d)).select("listing_id", "price", "area")


@query(
    "fill_numeric_sentinel",
    "SELECT listing_id, " + ", ".join(f"coalesce({c}, '-1') AS {c}" for c in fixed.COUNT_COLUMNS) + " FROM raw",
    "raw",
)
def _(spark, d):
    return cols.fill_numeric_sentinel(v.raw(spark, d)).select("listing_id", *fixed.COUNT_COLUMNS)


@query(
    "fill_categorical_unknown",
    "SELECT listing_id, " + ", ".join(f"coalesce({c}, 'Không xác định') AS {c}" for c in fixed.LABEL_COLUMNS) + " FROM raw",
    "raw",
)
def _(spark, d):
    return cols.fill_categorical_unknown(v.raw(spark, d)).select("listing_id", *fixed.LABEL_COLUMNS)


@query(
    "alias_columns",
    'SELECT listing_id, area_m2 AS "area (m2)", street_width_m AS "street (m)", area_m2, street_width_m FROM clean_b',
    "clean_b",
)
def _(spark, d):
    both = cols.alias_columns(v.clean_b(spark, d))
    return v.widened(both.select("listing_id", "`area (m2)`", "`street (m)`", "area_m2", "street_width_m"))


@query("resolve_column", "SELECT district AS place, price AS value FROM clean", "clean")
def _(spark, d):
    df = v.clean(spark, d)
    place = cols.resolve_column(df, fixed.LOCATION_CANDIDATES)
    value = cols.resolve_column(df, fixed.PRICE_CANDIDATES, numeric_fallback=True)
    return v.widened(df.select(F.col(place).alias("place"), F.col(value).alias("value")))


@query("numeric_columns", "SELECT price, area_m2, floor_num, toilet_num, livingroom_num FROM clean", "clean")
def _(spark, d):
    df = v.clean(spark, d).select(*schemas.LISTINGS_CLEAN.names)
    return v.widened(df.select(*cols.numeric_columns(df, first=5)))


@query(
    "preview",
    "SELECT city_province, district, area_m2, price_per_m2, category FROM clean ORDER BY listing_id LIMIT 10",
    "clean",
)
def _(spark, d):
    shown = ["city_province", "district", "area_m2", "price_per_m2", "category"]
    return v.widened(cols.preview(v.clean(spark, d), shown, ["listing_id"]))


@query(
    "missing_flags",
    "SELECT listing_id, " + ", ".join(f"CASE WHEN {c} = -1 THEN 1 ELSE 0 END AS {c}_missing_flag" for c in NUM) + " FROM clean",
    "clean",
)
def _(spark, d):
    return cols.missing_flags(v.clean(spark, d)).select("listing_id", *[f"{c}_missing_flag" for c in NUM])


@query("add_placeholders", "SELECT listing_id, 0 AS area_m2_missing_flag, 0.0::DOUBLE AS price_log, price FROM clean", "clean")
def _(spark, d):
    values = {"area_m2_missing_flag": 0, "price_log": 0.0, "price": 0.0}
    filled = cols.add_placeholders(v.clean(spark, d), values)
    return v.widened(filled.select("listing_id", *values))


# --- filters --------------------------------------------------------------------------------------


@query("filter_price_present", "SELECT listing_id, price FROM raw WHERE price IS NOT NULL", "raw")
def _(spark, d):
    return filters.filter_price_present(v.raw(spark, d)).select("listing_id", "price")


@query(
    "filter_area_positive",
    f"SELECT listing_id, area FROM (SELECT listing_id, CAST({v.AREA_SQL} AS DOUBLE) AS area FROM raw) WHERE area > 0",
    "raw",
)
def _(spark, d):
    parsed = v.raw(spark, d).select("listing_id", text.parse_area(F.col("area")).alias("area"))
    return v.widened(filters.filter_area_positive(parsed))


@query(
    "filter_price_per_m2_band",
    "SELECT listing_id, ppm2 FROM (SELECT listing_id, price / area_m2 AS ppm2 FROM parsed WHERE area_m2 > 0) WHERE ppm2 BETWEEN 2e6 AND 1e8",
    "clean",
)
def _(spark, d):
    raw = v.raw(spark, d)
    priced = raw.select(
        "listing_id",
        numbers.price_per_m2(text.parse_price_total(F.col("price")), text.parse_area(F.col("area"))).alias("ppm2"),
    )
    return filters.filter_price_per_m2_band(priced, "ppm2")


@query(
    "filter_price_range",
    """SELECT listing_id, price_per_m2 FROM clean WHERE price_per_m2 BETWEEN
    (SELECT quantile_cont(price_per_m2, 0.25) FROM clean) AND (SELECT quantile_cont(price_per_m2, 0.75) FROM clean)""",
    "clean",
)
def _(spark, d):
    return v.widened(filters.filter_price_range(v.clean(spark, d)).select("listing_id", "price_per_m2"))


@query("filter_location", "SELECT listing_id, district FROM clean WHERE city_province = 'ASIA' AND district = 'NATION_12'", "clean")
def _(spark, d):
    return filters.filter_location(v.clean(spark, d), "ASIA", "NATION_12").select("listing_id", "district")


@query(
    "filter_similar",
    """SELECT listing_id, area_m2 FROM clean WHERE city_province = 'ASIA' AND district = 'NATION_12'
    AND area_m2 > 100.0 * 0.7::DOUBLE AND area_m2 < 100.0 * 1.3::DOUBLE""",
    "clean",
)
def _(spark, d):
    return v.widened(filters.filter_similar(v.clean(spark, d), "ASIA", "NATION_12", 100.0).select("listing_id", "area_m2"))


@query(
    "trim_p99_joint",
    """SELECT listing_id, price_per_m2, area_m2 FROM clean WHERE price_per_m2 < (SELECT quantile_cont(price_per_m2, 0.99) FROM clean)
    AND area_m2 < (SELECT quantile_cont(area_m2, 0.99) FROM clean)""",
    "clean",
)
def _(spark, d):
    return v.widened(filters.trim_p99_joint(v.clean(spark, d)).select("listing_id", "price_per_m2", "area_m2"))


@query(
    "trim_p99_sequential",
    "SELECT listing_id, price_per_m2, area_m2 FROM cheap WHERE area_m2 < (SELECT quantile_cont(area_m2, 0.99) FROM cheap)",
    "clean",
    more="cheap AS (SELECT * FROM clean WHERE price_per_m2 < (SELECT quantile_cont(price_per_m2, 0.99) FROM clean))",
)
def _(spark, d):
    return v.widened(filters.trim_p99_sequential(v.clean(spark, d)).select("listing_id", "price_per_m2", "area_m2"))


@query("filter_text_contains", "SELECT listing_id, price FROM raw WHERE price LIKE '%triệu%'", "raw")
def _(spark, d):
    return filters.filter_text_contains(v.raw(spark, d), "price", "triệu").select("listing_id", "price")


@query("filter_text_lacks", "SELECT listing_id, price FROM raw WHERE price NOT LIKE '%Thương lượng%'", "raw")
def _(spark, d):
    return filters.filter_text_contains(v.raw(spark, d), "price", "Thương lượng", negate=True).select("listing_id", "price")


@query("filter_text_icontains", "SELECT listing_id, location FROM raw WHERE lower(location) LIKE '%africa%'", "raw")
def _(spark, d):
    return filters.filter_text_icontains(v.raw(spark, d), "location", "Africa").select("listing_id", "location")


_TOP_CITIES = """top_cities AS (SELECT city_province FROM clean WHERE city_province IS NOT NULL GROUP BY 1
    ORDER BY quantile_cont(price_per_m2, 0.5) DESC, 1 LIMIT 3)"""


@query(
    "filter_top_cities",
    "SELECT listing_id, city_province FROM clean WHERE city_province IN (SELECT city_province FROM top_cities)",
    "clean",
    more=_TOP_CITIES,
)
def _(spark, d):
    df = v.clean(spark, d)
    medians = stats.median_by(df, "city_province")
    return ranking.keep_top_groups(df, medians, "median_price", "city_province", 3).select("listing_id", "city_province")


_LIMIT_CASES = ", ".join(
    f"CASE WHEN {c} < {low} OR {c} > {high} THEN 'out_of_range:{c}' END" for c, (low, high) in fixed.INPUT_LIMITS.items()
)
_REQUIRED_CASES = ", ".join(
    f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END" for c in fixed.CATEGORICAL_FEATURES + fixed.NUMERIC_FEATURES
)


@query(
    "validate_listing",
    f"""SELECT listing_id, array_to_string(e, ';') AS errors, array_to_string(w, ';') AS warnings, len(e) = 0 AS is_valid FROM (
    SELECT listing_id, list_filter([{_REQUIRED_CASES}, CASE WHEN area_m2 <= 0 THEN 'area_not_positive' END, {_LIMIT_CASES}],
    lambda x: x IS NOT NULL) AS e, list_filter([CASE WHEN area_m2 < 10 THEN 'area_too_small' END,
    CASE WHEN year(posting_ts) > 1998 THEN 'unusual_year' END], lambda x: x IS NOT NULL) AS w FROM clean_b)""",
    "clean_b",
)
def _(spark, d):
    df = cols.alias_columns(v.clean_b(spark, d)).withColumn("built", F.year("posting_ts"))
    checked = filters.validate_listing(df, year="built", as_of_year=1998)
    return checked.select(
        "listing_id", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"), "is_valid"
    )


# --- scalar functions -------------------------------------------------------------------------------




def _register_scalars() -> None:
    c = F.col
    parts = f"string_split({v.LOCATION_SQL.format('location')}, ',')"
    scalar_queries = {
        "clean_location": (f"{v.LOCATION_SQL.format('location')} AS place", lambda: {"place": text.clean_location(c("location"))}),
        "split_location": (
            f"trim({parts}[-2]) AS district, trim({parts}[-1]) AS city_province",
            lambda: dict(zip(("district", "city_province"), text.location_parts(c("location")), strict=True)),
        ),
        "parse_price_total": (f"CAST({v.PRICE_A_SQL} AS DOUBLE) AS total", lambda: {"total": text.parse_price_total(c("price"))}),
        "parse_price_unit": (f"CAST({v.PRICE_B_SQL} AS DOUBLE) AS unit_price", lambda: {"unit_price": text.parse_price_unit(c("price"))}),
        "parse_area": (f"CAST({v.AREA_SQL} AS DOUBLE) AS area_m2", lambda: {"area_m2": text.parse_area(c("area"))}),
        "parse_floor": (
            "try_cast(regexp_replace(floor_num, '\\s*tầng$', '') AS INTEGER) AS floors",
            lambda: {"floors": text.parse_floor(c("floor_num"))},
        ),
        "parse_bedroom": (
            "try_cast(regexp_replace(bedroom_num, '\\s*phòng$', '') AS INTEGER) AS bedrooms",
            lambda: {"bedrooms": text.parse_bedroom(c("bedroom_num"))},
        ),
        "parse_street_width": (f"CAST({v.STREET_SQL} AS DOUBLE) AS width", lambda: {"width": text.parse_street_width(c("street"))}),
    }
    for name, (sql, made) in scalar_queries.items():

        def run(spark, d, made=made):
            return v.widened(v.raw(spark, d).select("listing_id", *[x.alias(n) for n, x in made().items()]))

        query(name, f"SELECT listing_id, {sql} FROM raw", "raw")(run)


_register_scalars()


@query(
    "split_multivalue",
    """SELECT url, seq, part, unnest(string_split(features, '|')) AS feature FROM details WHERE features <> ''""",
    "details",
)
def _(spark, d):
    values = text.split_multivalue(F.col("features"))
    return v.details(spark, d).select("url", "seq", "part", F.explode(values).alias("feature"))


@query("join_multivalue", "SELECT url, seq, part, replace(features, '|', ', ') AS features FROM details", "details")
def _(spark, d):
    joined = text.join_multivalue(text.split_multivalue(F.col("features")), ", ")
    return v.details(spark, d).select("url", "seq", "part", joined.alias("features"))


@query("price_per_m2", "SELECT listing_id, CASE WHEN area_m2 > 0 THEN price / area_m2 END AS ppm2 FROM parsed", "clean")
def _(spark, d):
    ppm2 = numbers.price_per_m2(text.parse_price_total(F.col("price")), text.parse_area(F.col("area")))
    return v.raw(spark, d).select("listing_id", ppm2.alias("ppm2"))


@query("log1p_price", "SELECT listing_id, round(ln(1 + price_per_m2), 7) AS price_log FROM clean", "clean")
def _(spark, d):
    return v.clean(spark, d).select("listing_id", F.round(numbers.log_price(F.col("price_per_m2").cast("double")), 7).alias("price_log"))


@query("expm1_price", "SELECT listing_id, round((exp(area_m2 / 100) - 1), 6) AS value FROM clean", "clean")
def _(spark, d):
    return v.clean(spark, d).select("listing_id", F.round(numbers.unlog_price(F.col("area_m2").cast("double") / 100), 6).alias("value"))


_AMOUNT = "CAST(round_even(round_even(price_per_m2, 0) * area_m2, 0) AS BIGINT)"


@query("total_price", f"SELECT listing_id, {_AMOUNT} AS total, {_AMOUNT} / 1e9 AS billions FROM clean", "clean")
def _(spark, d):
    total = numbers.total_price(F.col("price_per_m2").cast("double"), F.col("area_m2").cast("double"))
    return v.clean(spark, d).select("listing_id", total.alias("total")).withColumn("billions", numbers.in_billions(F.col("total")))


def _amount_sql(amount: str) -> str:
    grouped = "format('{{:,}}', CAST({} AS BIGINT))".format
    branches = []
    units = fixed.AMOUNT_UNITS
    for i, (word, size) in enumerate(units):
        head = f"{grouped(f'{amount} // {size}')} || ' {word}'"
        if i + 1 < len(units):
            small_word, small = units[i + 1]
            rest = f"({amount} % {size}) // {small}"
            head += f" || CASE WHEN {rest} > 0 THEN ' ' || {grouped(rest)} || ' {small_word}' ELSE '' END"
        branches.append(f"WHEN {amount} >= {size} THEN {head} || ' VND'")
    return f"CASE {' '.join(branches)} ELSE {grouped(amount)} || ' VND' END"


@query(
    "format_price",
    f"SELECT listing_id, {_amount_sql('amount')} AS price_text FROM (SELECT listing_id, {_AMOUNT} // (listing_id % 7 * 99991 + 1) AS amount FROM clean)",
    "clean",
)
def _(spark, d):
    total = numbers.total_price(F.col("price_per_m2").cast("double"), F.col("area_m2").cast("double"))
    # Divided so that amounts of every size occur.
    amount = F.floor(total / (F.col("listing_id") % 7 * 99991 + 1))
    return v.clean(spark, d).select("listing_id", numbers.format_price(amount).alias("price_text"))


@query(
    "format_thousands",
    "SELECT listing_id, format('{:,.0f}', price_per_m2) AS price_text, format('{:.1f}', area_m2 / 4) AS area_text FROM clean",
    "clean",
)
def _(spark, d):
    price, area = F.col("price_per_m2").cast("double"), F.col("area_m2").cast("double") / 4
    return v.clean(spark, d).select(
        "listing_id", numbers.format_thousands(price).alias("price_text"), numbers.format_plain(area, 1).alias("area_text")
    )


@query(
    "share_of_total",
    """SELECT city_province, count(*) FILTER (direction = 'Đông') AS part, count(*) AS total,
    CAST(floor(count(*) FILTER (direction = 'Đông') / count(*) * 100) AS BIGINT) AS percent FROM clean GROUP BY 1""",
    "clean",
)
def _(spark, d):
    counts = v.clean(spark, d).groupBy("city_province").agg(
        F.count_if(F.col("direction") == "Đông").alias("part"), F.count("*").alias("total")
    )
    return counts.withColumn("percent", numbers.share_of_total(F.col("part"), F.col("total")))


@query("positive_size", "SELECT listing_id, greatest(1, coalesce(bedroom_num, 1)) AS size_value FROM clean", "clean")
def _(spark, d):
    return v.clean(spark, d).select("listing_id", numbers.positive_size(F.col("bedroom_num")).alias("size_value"))


@query("posting_month", "SELECT url, seq, part, CAST(month(ts) AS INTEGER) AS posting_month FROM details", "details")
def _(spark, d):
    return v.details(spark, d).select("url", "seq", "part", numbers.posting_month(F.col("posting_date")).alias("posting_month"))


@query("impute_median", "SELECT listing_id, " + ", ".join(NUM) + " FROM model_frame", "model_frame")
def _(spark, d):
    return cleaning.impute_median(v.clean(spark, d), NUM).select("listing_id", *NUM)


@query("clean_listings_a", f"SELECT {CLEAN_COLUMNS} FROM clean", "clean")
def _(spark, d):
    return v.widened(v.clean(spark, d).drop("posting_ts"))


@query(
    "cleaning_step_counts",
    f"""SELECT CAST(place AS INTEGER) AS place, step, n AS rows, coalesce(lag(n) OVER (ORDER BY place), n) - n AS dropped FROM (
    SELECT 0 AS place, 'read' AS step, count(*) AS n FROM raw UNION ALL
    SELECT 1, 'with_texts', count(*) FILTER (price IS NOT NULL AND area IS NOT NULL) FROM raw UNION ALL
    SELECT 2, 'priced', count(*) FROM raw WHERE area IS NOT NULL AND {v.PRICE_A_SQL} IS NOT NULL UNION ALL
    SELECT 3, 'with_area', count(*) FROM parsed WHERE price IS NOT NULL AND area_m2 > 0 UNION ALL
    SELECT 4, 'in_band', count(*) FROM clean)""",
    "clean",
)
def _(spark, d):
    cleaned, counts = cleaning.with_step_counts(v.raw(spark, d))
    stored(cleaned, "counted")
    return counts()


@query(
    "clean_listings_b",
    """SELECT listing_id, price_per_m2, area_m2 AS "area (m2)", category, direction, floor_num, toilet_num, livingroom_num,
    bedroom_num, liability, district, city_province, street_width_m AS "street (m)" FROM clean_b""",
    "clean_b",
)
def _(spark, d):
    return v.widened(v.clean_b(spark, d).drop("posting_ts"))


@query(
    "prepare_model_frame",
    "SELECT listing_id, " + ", ".join([*NUM, *[f"{c}_missing_flag" for c in NUM]]) + ", round(price_log, 7) AS price_log FROM model_frame",
    "model_frame",
)
def _(spark, d):
    frame = v.model_frame(spark, d)
    return _rounded(frame.select("listing_id", *NUM, *[f"{c}_missing_flag" for c in NUM], "price_log"), price_log=7)


# --- joins ------------------------------------------------------------------------------------------

_SIMILAR = """FROM clean s LEFT JOIN clean t ON s.city_province = t.city_province AND s.district = t.district
    AND t.area_m2 > s.area_m2 * 0.7::DOUBLE AND t.area_m2 < s.area_m2 * 1.3::DOUBLE"""


@query(
    "comparables_join",
    f"SELECT s.listing_id, count(t.listing_id) AS n_similar, avg(t.price_per_m2) AS avg_similar {_SIMILAR} GROUP BY 1",
    "clean",
)
def _(spark, d):
    df = v.clean(spark, d)
    return comparables.comparables_summary(df, df, "listing_id")


@query(
    "comparables_top5",
    f"""SELECT * FROM (SELECT s.listing_id AS subject_id, s.city_province, s.district, t.area_m2 AS similar_area,
    t.listing_id AS listing_key, t.price_per_m2, t.bedroom_num, t.floor_num, t.category,
    CAST(row_number() OVER (PARTITION BY s.listing_id ORDER BY abs(t.area_m2 - s.area_m2), t.listing_id) AS INTEGER) AS rank
    {_SIMILAR} WHERE t.listing_id IS NOT NULL) WHERE rank <= 5""",
    "clean",
)
def _(spark, d):
    df = v.clean(spark, d)
    subjects = df.withColumnRenamed("listing_id", "subject_id")
    return v.widened(comparables.comparables_top(subjects, df, "subject_id", "listing_id"))


# Subjects of every tier: other places and categories than those listed occur among them.
_SUBJECTS_SQL = """subjects AS (SELECT listing_id, CASE WHEN listing_id % 19 = 0 THEN 'Nowhere' ELSE city_province END AS city_province,
    CASE WHEN listing_id % 7 = 0 THEN 'Elsewhere' ELSE district END AS district,
    CASE WHEN listing_id % 5 = 0 THEN 'Other' ELSE category END AS category, area_m2 FROM clean)"""
_FALLBACK_SQL = (
    _SUBJECTS_SQL
    + """, tier1 AS (SELECT s.listing_id, count(t.listing_id) AS n, avg(t.price_per_m2) AS mean FROM subjects s JOIN clean t
    ON s.city_province = t.city_province AND s.district = t.district AND s.category = t.category
    AND t.area_m2 > s.area_m2 * 0.7::DOUBLE AND t.area_m2 < s.area_m2 * 1.3::DOUBLE GROUP BY 1),
    tier2 AS (SELECT city_province, district, count(*) AS n, avg(price_per_m2) AS mean FROM clean GROUP BY 1, 2),
    tier3 AS (SELECT city_province, count(*) AS n, avg(price_per_m2) AS mean FROM clean GROUP BY 1),
    fallback AS (SELECT s.listing_id, CASE WHEN t1.n >= 3 THEN 1 WHEN t2.n >= 3 THEN 2 WHEN t3.n > 0 THEN 3 ELSE 4 END AS tier,
    CASE WHEN t1.n >= 3 THEN t1.mean WHEN t2.n >= 3 THEN t2.mean WHEN t3.n > 0 THEN t3.mean
    ELSE (SELECT avg(price_per_m2) FROM clean) END AS estimate
    FROM subjects s LEFT JOIN tier1 t1 ON s.listing_id = t1.listing_id
    LEFT JOIN tier2 t2 ON s.city_province = t2.city_province AND s.district = t2.district
    LEFT JOIN tier3 t3 ON s.city_province = t3.city_province)"""
)


def _subjects(df: DataFrame) -> DataFrame:
    k = F.col("listing_id")
    return df.withColumns(
        {
            "city_province": F.when(k % 19 == 0, "Nowhere").otherwise(F.col("city_province")),
            "district": F.when(k % 7 == 0, "Elsewhere").otherwise(F.col("district")),
            "category": F.when(k % 5 == 0, "Other").otherwise(F.col("category")),
        }
    )


@query("fallback_estimate", "SELECT listing_id, tier, estimate FROM fallback", "clean", more=_FALLBACK_SQL)
def _(spark, d):
    df = v.clean(spark, d)
    return comparables.fallback_estimate(_subjects(df), df, "listing_id")


@query(
    "top_city_semi_join",
    """SELECT listing_id, city_province FROM clean WHERE city_province IN (SELECT city_province FROM clean
    WHERE city_province IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 2)""",
    "clean",
)
def _(spark, d):
    df = v.clean(spark, d)
    counts = stats.count_by(df, "city_province")
    return ranking.keep_top_groups(df, counts, "count", "city_province", 2).select("listing_id", "city_province")


# Map positions for the derived places; one name matches nothing.
_POSITIONS = {"africa": (1.5, 17.5), "America": (45.25, -100.0), "asia": (34.0, 100.5), "Middle": (29.5, 45.0), "Atlantis": (0.0, 0.0)}
_MAP_SQL = "gazetteer(city, lat, lon) AS (VALUES " + ", ".join(
    f"('{c}', {a}::DOUBLE, {b}::DOUBLE)" for c, (a, b) in _POSITIONS.items()
) + ")"
_MAP_SELECT = """SELECT city, lat, lon, avg(price_per_m2) AS avg_price, count(*) AS count{0} FROM clean
    JOIN gazetteer ON contains(lower(city_province), lower(city)) GROUP BY 1, 2, 3"""


@query("gazetteer_join", _MAP_SELECT.format(""), "clean", more=_MAP_SQL)
def _(spark, d):
    return stats.city_map_stats(v.clean(spark, d), _POSITIONS).drop("label")


@query(
    "city_map_stats",
    _MAP_SELECT.format(", concat(city, ': ', format('{:,.0f}', avg(price_per_m2)), ' VND/m²') AS label"),
    "clean",
    more=_MAP_SQL,
)
def _(spark, d):
    return stats.city_map_stats(v.clean(spark, d), _POSITIONS)


_LATEST = "SELECT * FROM {0} QUALIFY row_number() OVER (PARTITION BY {1} ORDER BY ts DESC, seq DESC, part DESC) = 1"


@query(
    "listing_details_join",
    """SELECT r.link, r.title, l.posting_date, l.contact_phone, l.features, l.image_urls, l.description FROM raw r
    LEFT JOIN latest l ON r.link = l.url""",
    "raw",
    "details",
    more=f"latest AS ({_LATEST.format('details', 'url')})",
)
def _(spark, d):
    joined = worklist.listing_details_join(v.raw(spark, d), v.details(spark, d), ["ts", "seq", "part"])
    return joined.select("link", "title", "posting_date", "contact_phone", "features", "image_urls", "description")


@query("latest_status", "SELECT link, status FROM latest", "status_log", more=f"latest AS ({_LATEST.format('status_log', 'link')})")
def _(spark, d):
    return worklist.latest_status(v.status_log(spark, d), order=["ts", "seq", "part"])


@query(
    "pending_links",
    "SELECT DISTINCT link FROM raw WHERE link NOT IN (SELECT link FROM latest WHERE status = 'processed')",
    "raw",
    "status_log",
    more=f"latest AS ({_LATEST.format('status_log', 'link')})",
)
def _(spark, d):
    return worklist.pending_links(v.raw(spark, d), v.status_log(spark, d), order=["ts", "seq", "part"])


# --- aggregates ---------------------------------------------------------------------------------------


@query("row_count", "SELECT count(*) AS rows FROM clean", "clean")
def _(spark, d):
    return stats.row_count(v.clean(spark, d))


@query("null_counts", "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in schemas.LISTINGS_RAW.names) + " FROM raw", "raw")
def _(spark, d):
    return stats.null_counts(v.raw_texts(spark, d))


@query(
    "quick_stats",
    "SELECT count(*) AS total, avg(price_per_m2) AS avg_price_per_m2, avg(area_m2) AS avg_area_m2, count(DISTINCT city_province) AS cities FROM clean",
    "clean",
)
def _(spark, d):
    return stats.quick_stats(v.clean(spark, d))


@query(
    "price_summary",
    """SELECT avg(price_per_m2) AS mean, max(price_per_m2) AS max, min(price_per_m2) AS min, count(price_per_m2) AS count,
    quantile_cont(price_per_m2, 0.5) AS median FROM clean""",
    "clean",
)
def _(spark, d):
    return stats.price_summary(v.clean(spark, d))


def _mean_sql(key: str, value: str = "price_per_m2", name: str = "avg_price", top: int | None = None) -> str:
    tail = f" ORDER BY {name} DESC, {key} LIMIT {top}" if top else ""
    return f"SELECT {key}, avg({value}) AS {name} FROM clean WHERE {key} IS NOT NULL GROUP BY {key}{tail}"


def _register_means() -> None:
    def add(name, sql, fn):
        query(name, sql, "clean")(lambda spark, d: fn(v.clean(spark, d)))

    add("avg_price_by_city", _mean_sql("city_province", top=10), lambda df: stats.mean_by(df, "city_province", top=10))
    add(
        "avg_price_by_district",
        "SELECT city_province, district, avg(price_per_m2) AS avg_price FROM clean WHERE district IS NOT NULL AND city_province IS NOT NULL GROUP BY 1, 2",
        lambda df: stats.mean_by(df, ["city_province", "district"]),
    )
    for key in ("category", "direction", "liability"):
        add(f"avg_price_by_{key}", _mean_sql(key), lambda df, key=key: stats.mean_by(df, key))
    for key, label in (("bedroom_num", "bedrooms"), ("floor_num", "floors"), ("toilet_num", "toilets")):
        add(f"avg_price_by_{label}", _mean_sql(key), lambda df, key=key: stats.mean_by_number(df, key))
    add(
        "avg_area_by_region",
        _mean_sql("district", "area_m2", "avg_area", 10),
        lambda df: stats.mean_by(
            df,
            cols.resolve_column(df, fixed.LOCATION_CANDIDATES),
            cols.resolve_column(df, fixed.AREA_CANDIDATES, True),
            "avg_area",
            10,
        ),
    )
    add(
        "avg_price_by_region",
        _mean_sql("district", "price", "avg_price", 10),
        lambda df: stats.mean_by(
            df, cols.resolve_column(df, fixed.LOCATION_CANDIDATES), cols.resolve_column(df, fixed.PRICE_CANDIDATES, True), top=10
        ),
    )
    add(
        "median_price_by_city",
        "SELECT city_province, quantile_cont(price_per_m2, 0.5) AS median_price FROM clean WHERE city_province IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        lambda df: stats.median_by(df, "city_province", top=10),
    )
    add(
        "listing_count_by_region",
        "SELECT district, count(*) AS count FROM clean WHERE district IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        lambda df: stats.count_by(df, "district", top=10),
    )


_register_means()


@query(
    "region_overview",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS groups, arg_max(value, (n, -place)) AS most_frequent, max(n) AS largest_group,
        min(n) AS smallest_group FROM (SELECT {c} AS value, count(*) AS n, row_number() OVER (ORDER BY {c}) AS place
        FROM clean WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("city_province", "district")
    ),
    "clean",
)
def _(spark, d):
    return stats.region_overview(v.clean(spark, d))


@query(
    "distinct_options",
    " UNION ALL ".join(f"""SELECT DISTINCT '{c}' AS "column", {c} AS value FROM clean WHERE {c} IS NOT NULL""" for c in fixed.CATEGORICAL_FEATURES),
    "clean",
)
def _(spark, d):
    return stats.distinct_options(v.clean(spark, d), fixed.CATEGORICAL_FEATURES)


@query("districts_by_city", "SELECT DISTINCT city_province, district FROM clean WHERE district IS NOT NULL AND city_province IS NOT NULL", "clean")
def _(spark, d):
    return stats.districts_by_city(v.clean(spark, d))


@query("price_area_corr", "SELECT round(corr(price_per_m2, area_m2), 8) AS corr FROM clean", "clean")
def _(spark, d):
    return _rounded(stats.pair_corr(v.clean(spark, d)), corr=8)


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS "row", '{b}' AS "column", round({f'CASE WHEN max({a}) > min({a}) THEN 1.0 END' if a == b else f'corr({a}, {b})'}::DOUBLE, 8) AS corr FROM clean"""
        for a in NUM7
        for b in NUM7
    ),
    "clean",
)
def _(spark, d):
    return _rounded(stats.corr_matrix(v.clean(spark, d)), corr=8)


@query(
    "corr_matrix_wide",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS "row", """
        + ", ".join(f"round({'CASE WHEN max(' + a + ') > min(' + a + ') THEN 1.0 END' if a == b else f'corr({a}, {b})'}::DOUBLE, 8) AS {b}" for b in NUM7)
        + " FROM clean"
        for a in NUM7
    ),
    "clean",
)
def _(spark, d):
    return _rounded(stats.corr_matrix_wide(v.clean(spark, d)), **{c: 8 for c in NUM7})


@query(
    "price_quantiles",
    "SELECT " + ", ".join(f"round(quantile_cont(price_per_m2, {p}), 3) AS {n}" for n, p in (("p01", 0.01), ("p25", 0.25), ("p75", 0.75), ("p99", 0.99))) + " FROM clean",
    "clean",
)
def _(spark, d):
    return _rounded(stats.price_quantiles(v.clean(spark, d)), p01=3, p25=3, p75=3, p99=3)


@query("approx_medians", f"SELECT unnest({NUM!r}) AS column, true AS near")
def _(spark, d):
    """Whether each approximate median lies within one percent of the rank one half."""
    df = v.clean(spark, d)
    found = quantiles.approx_medians(df, NUM)
    known = {c: F.when(F.col(c) != -1, F.col(c).cast("double")) for c in NUM}
    share = lambda c, test: F.count(F.when(test, 1)) / F.count(known[c])
    near = [((share(c, known[c] < found[c]) <= 0.51) & (share(c, known[c] <= found[c]) >= 0.49)).alias(c) for c in NUM]
    return df.agg(*near).unpivot([], NUM, "column", "near")


@query(
    "merged_median_by_city",
    "SELECT city_province, count(price_per_m2) AS rows, true AS near FROM clean WHERE city_province IS NOT NULL GROUP BY 1",
    "clean",
)
def _(spark, d):
    """Sketches per city and month of posting, stored and merged per city: is each median within one percent of rank?"""
    df = v.clean(spark, d).filter("city_province is not null and price_per_m2 is not null")
    fine = stored(sketches.quantile_sketches(df, "price_per_m2", ["city_province", F.month("posting_ts").alias("month")]), "sketches")
    found = sketches.sketched_quantiles(sketches.merged_sketches(fine, ["city_province"]), {"median": 0.5})
    x = F.col("price_per_m2").cast("double")
    share = lambda test: F.count(F.when(test, 1)) / F.count("*")
    near = (share(x < F.col("median")) <= 0.51) & (share(x <= F.col("median")) >= 0.49)
    return df.join(found, "city_province").groupBy("city_province", "rows").agg(near.alias("near"))


def _place_sql(p: str) -> str:
    """The values on either side of the place p * (n - 1) of the sorted list, and the one between them."""
    at, name = f"CAST({p} AS DECIMAL(10,9)) * (n - 1)", "p" + p[2:]
    low, high = f"s[1 + CAST(floor({at}) AS BIGINT)]", f"s[1 + CAST(ceil({at}) AS BIGINT)]"
    return f"{low} AS {name}_low, {high} AS {name}_high"


_LARGE = {"large": "o_orderkey * 153722867280912 + 9007199254740993", "exact": "CAST(o_totalprice AS DECIMAL(20,2)) * 10000000000000000 + o_orderkey"}


def _large_quantiles_sql(name: str) -> str:
    kind = "DECIMAL(38,0)" if name == "large" else "DECIMAL(38,2)"
    return f"""SELECT o_orderstatus, {", ".join(_place_sql(p) for p in ("0.25", "0.50", "0.99"))}
    FROM (SELECT o_orderstatus, list(x ORDER BY x) AS s, count(*) AS n FROM (SELECT o_orderstatus, CAST({_LARGE[name]} AS {kind}) AS x FROM orders) GROUP BY 1)"""


def _large_quantiles(spark, d, name: str) -> DataFrame:
    kind = "decimal(38,0)" if name == "large" else "decimal(38,2)"
    # Keys as decimals: above 59,941 the product no longer fits into 64 bits.
    orders = v.table(spark, d, "orders").withColumn("o_orderkey", F.col("o_orderkey").cast("decimal(20,0)"))
    rows = orders.select("o_orderstatus", F.expr(f"cast({_LARGE[name]} as {kind})").alias("x"))
    found = quantiles.exact_decimal_quantiles(rows, "x", {"p25": "0.25", "p50": "0.50", "p99": "0.99"}, ["o_orderstatus"])
    return found.drop("p25", "p50", "p99")


@query("exact_bigint_quantiles", _large_quantiles_sql("large"))
def _(spark, d):
    return _large_quantiles(spark, d, "large")


@query("exact_decimal_quantiles", _large_quantiles_sql("exact"))
def _(spark, d):
    return _large_quantiles(spark, d, "exact")


@query(
    "trimmed_price_range",
    """SELECT max(price_per_m2) FILTER (price_per_m2 < (SELECT quantile_cont(price_per_m2, 0.99) FROM clean))
    - min(price_per_m2) FILTER (price_per_m2 > (SELECT quantile_cont(price_per_m2, 0.01) FROM clean)) AS price_range FROM clean""",
    "clean",
)
def _(spark, d):
    return stats.trimmed_price_range(v.clean(spark, d))


def _histogram_sql(source: str, bins: str) -> str:
    return f"""SELECT CAST(b.bin AS INTEGER) AS bin, round(low + b.bin * width, {{digits}}) AS low,
    round(low + (b.bin + 1) * width, {{digits}}) AS high, coalesce(n, 0) AS count
    FROM (SELECT low, width, unnest(range(0, CAST(bins AS BIGINT))) AS bin FROM frame) b LEFT JOIN (
    SELECT CAST(least(floor((x - low) / width), bins - 1) AS BIGINT) AS bin, count(*) AS n FROM {source}, frame GROUP BY 1) c
    ON b.bin = c.bin"""


_AUTO_BINS = """ceil(greatest(log2(count(*)) + 1, (max(x) - min(x)) /
    (2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) * pow(count(*), -1 / 3.0::DOUBLE))))"""


def _frame_sql(select: str, bins: str) -> str:
    return f"""xs AS ({select}), frame AS (SELECT min(x) AS low, bins, (max(x) - min(x)) / bins AS width
    FROM xs, (SELECT {bins} AS bins FROM xs) GROUP BY bins)"""


@query("price_histogram", _histogram_sql("xs", "").format(digits=3), "clean", more=_frame_sql("SELECT price_per_m2 AS x FROM clean", _AUTO_BINS))
def _(spark, d):
    return _rounded(distributions.histogram(v.clean(spark, d), bins=None), low=3, high=3)


@query(
    "log_price_histogram",
    _histogram_sql("xs", "").format(digits=7),
    "clean",
    more=_frame_sql("SELECT ln(1 + price_per_m2) AS x FROM clean", "50 * max(1)"),
)
def _(spark, d):
    return _rounded(distributions.histogram(v.clean(spark, d), bins=50, log=True), low=7, high=7)


@query(
    "trimmed_price_histogram",
    _histogram_sql("xs", "").format(digits=3),
    "clean",
    more=_frame_sql(
        "SELECT price_per_m2 AS x FROM clean WHERE price_per_m2 < (SELECT quantile_cont(price_per_m2, 0.99) FROM clean)", "50 * max(1)"
    ),
)
def _(spark, d):
    return _rounded(distributions.trimmed_histogram(v.clean(spark, d)), low=3, high=3)


def _density_sql(x: str, scale: str, digits: int) -> str:
    return f"""SELECT CAST(point AS INTEGER) AS point, round(low + point * (high - low) / 199, {digits}) AS x,
    round(sum(exp(-pow((low + point * (high - low) / 199 - {x}) / width, 2) / 2)) / any_value(n * width * sqrt(2 * pi())) * {scale}, 6) AS density
    FROM clean, (SELECT min({x}) AS low, max({x}) AS high, count(*) AS n, stddev_samp({x}) * pow(count(*), -0.2) AS width FROM clean),
    (SELECT unnest(range(0, 200)) AS point) GROUP BY point, low, high"""


@query("price_kde", _density_sql("price_per_m2", "1e8", 3), "clean")
def _(spark, d):
    curve = distributions.density(v.clean(spark, d))
    return _rounded(curve.withColumn("density", F.col("density") * 1e8), x=3, density=6)


@query("log_price_kde", _density_sql("ln(1 + price_per_m2)", "1", 7), "clean")
def _(spark, d):
    return _rounded(distributions.density(v.clean(spark, d), log=True), x=7, density=6)


_CELLS = """frame AS (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high, count(*) AS n,
    stddev_samp(l_extendedprice) * pow(count(*), -0.2::DOUBLE) AS width FROM lineitem),
    placed AS (SELECT (l_extendedprice - low) / (width / 40) AS place FROM lineitem, frame),
    cells AS (SELECT cell, sum(weight) AS weight FROM (SELECT floor(place) AS cell, 1 - (place - floor(place)) AS weight FROM placed
    UNION ALL SELECT floor(place) + 1, place - floor(place) FROM placed) GROUP BY 1)"""


@query(
    "price_kde_binned",
    """SELECT CAST(point AS INTEGER) AS point, round(low + point * (high - low) / 199, 3) AS x,
    round(sum(weight * exp(-pow((point * (high - low) / 199 - cell * width / 40) / width, 2) / 2)) / any_value(n * width * sqrt(2 * pi())) * 1e5, 6) AS density
    FROM cells, frame, (SELECT unnest(range(0, 200)) AS point) GROUP BY point, low, high""",
    more=_CELLS,
)
def _(spark, d):
    curve = distributions.binned_density(v.table(spark, d, "lineitem"), "l_extendedprice")
    return _rounded(curve.withColumn("density", F.col("density") * 1e5), x=3, density=6)


@query(
    "price_boxplot_by_city",
    """SELECT c.city_province, round(q1, 3) AS q1, round(median, 3) AS median, round(q3, 3) AS q3,
    min(price_per_m2) FILTER (price_per_m2 BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
    max(price_per_m2) FILTER (price_per_m2 BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
    count(*) FILTER (NOT price_per_m2 BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers, count(*) AS count
    FROM clean c JOIN boxes b ON c.city_province = b.city_province GROUP BY c.city_province, q1, median, q3""",
    "clean",
    more="""boxes AS (SELECT city_province, quantile_cont(price_per_m2, 0.25) AS q1, quantile_cont(price_per_m2, 0.5) AS median,
    quantile_cont(price_per_m2, 0.75) AS q3 FROM clean WHERE city_province IS NOT NULL GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10)""",
)
def _(spark, d):
    return _rounded(distributions.boxplot_by(v.clean(spark, d)), q1=3, median=3, q3=3)


@query(
    "monthly_price_trend",
    """SELECT CAST(month(ts) AS INTEGER) AS posting_month, avg(price_per_m2) AS avg_price FROM clean
    JOIN latest ON concat('http://listing/', listing_id) = url GROUP BY 1""",
    "clean",
    "details",
    more=f"latest AS ({_LATEST.format('details', 'url')})",
)
def _(spark, d):
    # The posting date lives on the detail page, so the trend needs the join.
    kept = cleaning.clean_listings_a(v.raw(spark, d), unused=["title"])
    dated = worklist.listing_details_join(kept, v.details(spark, d), ["ts", "seq", "part"])
    return stats.monthly_price_trend(dated, numbers.posting_month(F.col("posting_date")))


@query(
    "range_selection_summary",
    """SELECT count(*) FILTER (c) AS selected, count(*) AS total, avg(price_per_m2) FILTER (c) AS avg_price, avg(area_m2) FILTER (c) AS avg_area,
    CAST(floor(count(*) FILTER (c) / count(*) * 100) AS BIGINT) AS percent FROM (SELECT *, price_per_m2 BETWEEN 1e7 AND 3e7 AS c FROM clean)""",
    "clean",
)
def _(spark, d):
    return stats.range_selection_summary(v.clean(spark, d), 1e7, 3e7)


@query(
    "neighborhood_min_avg_max",
    """SELECT city_province, district, min(price_per_m2) AS min_price, avg(price_per_m2) AS avg_price, max(price_per_m2) AS max_price
    FROM clean WHERE city_province IS NOT NULL AND district IS NOT NULL GROUP BY 1, 2""",
    "clean",
)
def _(spark, d):
    return stats.neighborhood_min_avg_max(v.clean(spark, d))


@query(
    "feature_overview",
    """SELECT avg(area_m2) AS avg_area, avg(bedroom_num) AS avg_bedrooms, round(corr(price_per_m2, area_m2), 8) AS price_area_corr,
    8 AS numeric_columns FROM clean""",
    "clean",
)
def _(spark, d):
    return _rounded(stats.feature_overview(v.clean(spark, d).select(*schemas.LISTINGS_CLEAN.names)), price_area_corr=8)


_SAMPLED = "sampled AS (SELECT * FROM clean ORDER BY md5(CAST(listing_id AS VARCHAR)), listing_id LIMIT 1000)"
_POINT_COLUMNS = """listing_id, area_m2, price_per_m2, city_province, greatest(1, coalesce(bedroom_num, 1)) AS size_value, district,
    category, bedroom_num, floor_num"""


@query(
    "area_price_points",
    f"""SELECT {_POINT_COLUMNS} FROM sampled WHERE price_per_m2 < (SELECT quantile_cont(price_per_m2, 0.99) FROM sampled)
    AND area_m2 < (SELECT quantile_cont(area_m2, 0.99) FROM sampled)""",
    "clean",
    more=_SAMPLED,
)
def _(spark, d):
    return v.widened(distributions.area_price_points(v.clean(spark, d), "listing_id"))


# --- order, sample, split --------------------------------------------------------------------------------


@query("top_k_groups", "SELECT district, count(*) AS count FROM clean WHERE district IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", "clean")
def _(spark, d):
    return ranking.top_k_groups(stats.count_by(v.clean(spark, d), "district"), "count", "district", 5)


@query("sorted_distinct", "SELECT DISTINCT district FROM clean WHERE district IS NOT NULL", "clean")
def _(spark, d):
    return ranking.sorted_distinct(v.clean(spark, d), "district")


@query(
    "numeric_order_of_text",
    "SELECT CAST(floor_num AS VARCHAR) AS floor_text, avg(price_per_m2) AS avg_price FROM clean WHERE floor_num IS NOT NULL GROUP BY 1",
    "clean",
)
def _(spark, d):
    as_text = v.clean(spark, d).withColumn("floor_text", F.col("floor_num").cast("string"))
    return ranking.numeric_order_of_text(stats.mean_by(as_text, "floor_text"), "floor_text")


@query("head_n", "SELECT listing_id, price_per_m2 FROM clean ORDER BY listing_id LIMIT 5", "clean")
def _(spark, d):
    return v.widened(ranking.head_n(v.clean(spark, d), ["listing_id"]).select("listing_id", "price_per_m2"))


@query("sample_n", "SELECT listing_id, price_per_m2 FROM sampled", "clean", more=_SAMPLED)
def _(spark, d):
    return v.widened(ranking.sample_n(v.clean(spark, d), "listing_id").select("listing_id", "price_per_m2"))


@query(
    "train_test_split",
    "SELECT listing_id, CASE WHEN CAST('0x' || substr(md5(CAST(listing_id AS VARCHAR)), 1, 8) AS BIGINT) < 3435973837 THEN 'train' ELSE 'test' END AS part FROM clean",
    "clean",
)
def _(spark, d):
    part = F.when(ranking.in_train("listing_id"), "train").otherwise("test")
    return v.clean(spark, d).select("listing_id", part.alias("part"))


# --- models ------------------------------------------------------------------------------------------------

_INDEX_SQL = """indexed AS (SELECT district, CAST(row_number() OVER (ORDER BY n DESC, district) - 1 AS DOUBLE) AS place
    FROM (SELECT district, count(*) AS n FROM clean WHERE district IS NOT NULL GROUP BY 1))"""


@query(
    "string_index",
    "SELECT listing_id, coalesce(place, (SELECT count(*) FROM indexed))::DOUBLE AS district_index FROM clean c LEFT JOIN indexed i ON c.district = i.district",
    "clean",
    more=_INDEX_SQL,
)
def _(spark, d):
    df = v.clean(spark, d)
    return features.string_indexer(["district"]).fit(df).transform(df).select("listing_id", "district_index")


@query(
    "one_hot",
    "SELECT listing_id, CAST(coalesce(place, -1) AS BIGINT) AS hot_slot FROM clean c LEFT JOIN indexed i ON c.district = i.district",
    "clean",
    more=_INDEX_SQL,
)
def _(spark, d):
    from pyspark.ml.functions import vector_to_array

    df = v.clean(spark, d)
    indexed = features.string_indexer(["district"]).fit(df).transform(df)
    encoded = features.one_hot_encoder(["district"]).fit(indexed).transform(indexed)
    hot = F.array_position(vector_to_array("district_vec"), 1.0) - 1
    return encoded.select("listing_id", hot.cast("bigint").alias("hot_slot"))


_SLOT_SUM = " + ".join(f"{c}_missing_flag + {c}" for c in NUM) + " + 4 + CASE WHEN district IS NULL THEN 0 ELSE 1 END"


@query(
    "assemble",
    f"""SELECT listing_id, CAST((SELECT count(DISTINCT category) + count(DISTINCT direction) + count(DISTINCT liability)
    + count(DISTINCT district) + count(DISTINCT city_province) + 12 FROM model_frame) AS INTEGER) AS slots,
    round({_SLOT_SUM}, 4)::DOUBLE AS slot_sum FROM model_frame""",
    "model_frame",
)
def _(spark, d):
    from pyspark.ml.functions import vector_to_array

    frame = v.clean(spark, d)
    prepared = features.fit_features(frame, features.LOG_FULL)
    slots = vector_to_array(F.col("features"))
    total = F.aggregate(slots, F.lit(0.0), lambda acc, x: acc + x)
    return prepared.transform(frame).select(
        "listing_id", F.size(slots).alias("slots"), F.round(total, 4).alias("slot_sum")
    )


@query(
    "standardize",
    "SELECT listing_id, "
    + ", ".join(f"round(({c} - (SELECT avg({c}) FROM model_frame)) / (SELECT stddev_samp({c}) FROM model_frame), 7) AS {c}_scaled" for c in NUM)
    + " FROM model_frame",
    "model_frame",
)
def _(spark, d):
    scaled = features.standardized(v.model_frame(spark, d))
    return _rounded(scaled.select("listing_id", *[f"{c}_scaled" for c in NUM]), **{f"{c}_scaled": 7 for c in NUM})


@query(
    "scale_vector",
    "SELECT listing_id, " + ", ".join(f"round({c} / (SELECT stddev_samp({c}) FROM model_frame), 7) AS {c}" for c in NUM) + " FROM model_frame",
    "model_frame",
)
def _(spark, d):
    from pyspark.ml.functions import vector_to_array

    frame = v.model_frame(spark, d)
    preset = replace(features.RAW_QUICK, categorical=["direction"])
    prepared = features.fit_features(frame, preset)
    slots = vector_to_array("scaled_features")
    width = F.size(slots)
    tail = {c: F.round(F.get(slots, width - len(NUM) + i), 7) for i, c in enumerate(NUM)}
    return prepared.transform(frame).select("listing_id", *[x.alias(c) for c, x in tail.items()])


def _labelled(spark, d) -> DataFrame:
    """Cleaned listings with the label; unknown numbers are still -1, as the models fill them."""
    return stored(v.clean(spark, d).withColumn("price_log", numbers.log_price(F.col("price_per_m2").cast("double"))), "labelled")


def _parts(spark, d):
    return ranking.train_test_split(_labelled(spark, d), "listing_id")


_METRIC_NAMES = ("RMSE", "MSE", "MAE", "R2")


def _sound_sql(*names: str) -> str:
    rows = ", ".join(f"('{n}', '{m}')" for n in names for m in _METRIC_NAMES)
    return f"SELECT model, metric, true AS sound FROM (VALUES {rows}) AS t(model, metric)"


def _sound(metrics: DataFrame) -> DataFrame:
    """Whether each metric is possible, and the model better than the mean of all prices."""
    value = F.col("value")
    return metrics.select("model", "metric", F.coalesce((value > 0) & ~F.isnan(value) & ((F.col("metric") != "R2") | (value <= 1)), F.lit(False)).alias("sound"))


def _trained(name: str) -> None:
    @query(f"train_{'gbt' if name == 'boosted' else name}", _sound_sql(name))
    def _(spark, d):
        train, test = _parts(spark, d)
        fitted = models.train_models(train, features.LOG_FULL, {name: models.FULL_SETTINGS[name]})
        return _sound(models.regression_metrics(models.predictions_long(fitted, test, ["price_per_m2"])))


for _name in models.FULL_SETTINGS:
    _trained(_name)


@query("train_gbt_quick", _sound_sql("quick"))
def _(spark, d):
    train, test = _parts(spark, d)
    fitted = {"quick": models.train_one(train, features.RAW_QUICK, "boosted", models.QUICK_BOOSTED)}
    predicted = models.predictions_long(fitted, test, ["price_per_m2"])
    return _sound(models.regression_metrics(predicted, log_label=False))


@query(
    "train_and_choose",
    f"SELECT model, count(*) AS metrics, true AS sound, true AS agrees FROM ({_sound_sql('linear', 'tree', 'forest', 'boosted')}) GROUP BY 1",
)
def _(spark, d):
    train, test = _parts(spark, d)
    best, _all, metrics = models.train_and_choose(train, test, features.LOG_FULL)
    top = metrics.filter("metric = 'R2'").agg(F.max_by("model", "value")).first()[0]
    by_model = _sound(metrics).groupBy("model").agg(F.count("*").alias("metrics"), F.bool_and("sound").alias("sound"))
    return by_model.withColumn("agrees", F.lit(top == best))


_ONE_NUMBER = replace(features.RAW_QUICK, categorical=["direction"], numeric=["area_m2"])


def _on_one_number(spark, d, name: str, settings: dict) -> DataFrame:
    """Predictions of a model that sees the area alone, as one direction is given to all listings."""
    frame = stored(v.clean(spark, d).select("listing_id", "area_m2", "price_per_m2", F.lit("any").alias("direction")), "one-number")
    fitted = models.train_one(frame, _ONE_NUMBER, name, settings)
    return scoring.score_batch(frame, fitted, _ONE_NUMBER, ["listing_id"]).select(
        "listing_id", F.round(F.col("predicted_price_per_m2") / 1e6, 5).alias("millions")
    )


@query(
    "linear_on_area",
    "SELECT listing_id, round((intercept + slope * area_m2) / 1e6, 5) AS millions FROM clean, line",
    "clean",
    more="line AS (SELECT regr_slope(price_per_m2, area_m2) AS slope, regr_intercept(price_per_m2, area_m2) AS intercept FROM clean)",
)
def _(spark, d):
    """The trained line is the least-squares line of SQL."""
    return _on_one_number(spark, d, "linear", models.FULL_SETTINGS["linear"])


@query(
    "stump_on_area",
    "SELECT listing_id, round(CASE WHEN area_m2 <= cut THEN below ELSE above END / 1e6, 5) AS millions FROM clean, best",
    "clean",
    more="""areas AS (SELECT area_m2, count(*) AS n, sum(price_per_m2) AS y FROM clean GROUP BY 1),
    sides AS (SELECT area_m2 AS cut, sum(n) OVER w AS n, sum(y) OVER w AS y, sum(n) OVER () AS all_n, sum(y) OVER () AS all_y FROM areas
    WINDOW w AS (ORDER BY area_m2)),
    best AS (SELECT cut, y / n AS below, (all_y - y) / (all_n - n) AS above FROM sides WHERE n < all_n
    ORDER BY y / n * y + (all_y - y) / (all_n - n) * (all_y - y) DESC LIMIT 1)""",
)
def _(spark, d):
    """A tree of depth one makes the split that SQL finds by trying every area."""
    return _on_one_number(spark, d, "tree", {"maxDepth": 1, "maxBins": 1024})


# Predictions that need no model: the label, shifted by the listing's key.
_PREDICTED_SQL = """predicted AS (SELECT listing_id, price_per_m2, model, CASE WHEN listing_id % 19 = 0 THEN NULL
    ELSE price_log + (listing_id % 21 - 10) * step END AS prediction FROM model_frame,
    (VALUES ('coarse', 0.05::DOUBLE), ('fine', 0.01::DOUBLE)) AS m(model, step))"""
_METRICS_SQL = _PREDICTED_SQL + """, errors AS (SELECT model, price_per_m2 AS y, exp(prediction) - 1 AS p FROM predicted WHERE prediction IS NOT NULL),
    wide AS (SELECT model, avg(pow(y - p, 2)) AS mse, avg(abs(y - p)) AS mae, var_pop(y) AS spread FROM errors GROUP BY 1),
    metrics AS (SELECT model, 'RMSE' AS metric, round(sqrt(mse) / 1e6, 6) AS value FROM wide UNION ALL
    SELECT model, 'MSE', round(mse / 1e12, 6) FROM wide UNION ALL SELECT model, 'MAE', round(mae / 1e6, 6) FROM wide
    UNION ALL SELECT model, 'R2', round(1 - mse / spread, 6) FROM wide)"""


def _predicted(spark, d) -> DataFrame:
    steps = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("step")) for m, s in (("coarse", 0.05), ("fine", 0.01))])
    k = F.col("listing_id")
    guess = F.when(k % 19 != 0, F.col("price_log") + (k % 21 - 10) * F.col("step"))
    frame = v.model_frame(spark, d).select("*", F.inline(steps))
    return frame.withColumn("prediction", guess).withColumn("price_per_m2", F.col("price_per_m2").cast("double"))


@query("regression_metrics", "SELECT model, metric, value FROM metrics", "model_frame", more=_METRICS_SQL)
def _(spark, d):
    table = models.regression_metrics(_predicted(spark, d))
    unit = F.when(F.col("metric").isin("RMSE", "MAE"), 1e6).when(F.col("metric") == "MSE", 1e12).otherwise(1.0)
    return table.withColumn("value", F.round(F.col("value") / unit, 6))


@query(
    "select_best",
    "SELECT model, value AS r2 FROM metrics WHERE metric = 'R2' ORDER BY value DESC, model LIMIT 1",
    "model_frame",
    more=_METRICS_SQL,
)
def _(spark, d):
    return _rounded(models.select_best(models.regression_metrics(_predicted(spark, d))), r2=6)


@query(
    "feature_importance",
    f"""SELECT slot, true AS held FROM (VALUES {", ".join(f"('{c}_filled'), ('{c}_unknown')" for c in NUM)}) AS t(slot) UNION ALL
    SELECT 'sum', true UNION ALL SELECT 'rest', true""",
    "clean",
)
def _(spark, d):
    """Every numeric slot is named, no importance is negative and all add up to one."""
    train, _test = _parts(spark, d)
    fitted = models.train_models(train, features.LOG_FULL, {"tree": models.FULL_SETTINGS["tree"]})["tree"]
    table = models.feature_importance(fitted, fitted.transform(train), top=1_000_000)
    number = [f"{c}_{end}" for c in NUM for end in ("filled", "unknown")]
    named = table.filter(F.col("feature").isin(number)).select(F.col("feature").alias("slot"), (F.col("importance") >= 0).alias("held"))
    total = table.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("held")).select(F.lit("sum").alias("slot"), "held")
    rest = table.filter(~F.col("feature").isin(number)).agg((F.min("importance") >= 0).alias("held")).select(F.lit("rest").alias("slot"), "held")
    return named.unionByName(total).unionByName(rest)


# A label that is an exact function of the filled numbers, so that every prediction is known.
_KNOWN_LABEL = "2 + 0.01 * area_m2 + 0.25 * bedroom_num + 0.125 * floor_num"


def _known(spark, d) -> DataFrame:
    """Listings with the known label, made of the filled numbers, beside their unfilled numbers."""
    filled = v.model_frame(spark, d).select("listing_id", F.expr(_KNOWN_LABEL).alias("price_log"))
    plain = v.clean(spark, d)
    return stored(plain.join(filled, "listing_id"), "known-label")


@query(
    "score_batch",
    f"SELECT listing_id, true AS as_known FROM (SELECT listing_id, {_KNOWN_LABEL} AS price_log FROM model_frame) WHERE price_log IS NOT NULL",
    "model_frame",
)
def _(spark, d):
    """As many rows out as in; the linear model finds the label, with its own medians for -1, null and absent numbers."""
    known = _known(spark, d)
    fitted = models.train_models(known, features.LOG_FULL, {"linear": models.FULL_SETTINGS["linear"]})["linear"]
    unknown = {c: F.when((F.col(c) == -1) & (F.col("listing_id") % 2 == 0), None).otherwise(F.col(c)) for c in NUM}
    scored = scoring.score_batch(known.withColumns(unknown), fitted, features.LOG_FULL, ["listing_id", "price_log"])
    guess = F.log1p("predicted_price_per_m2")
    return scored.select("listing_id", (F.abs(guess - F.col("price_log")) < 0.02).alias("as_known"))


@query("save_and_load_model", "SELECT listing_id, true AS same FROM clean", "clean")
def _(spark, d):
    """The loaded model scores subjects with -1 and null as the kept one scores the imputed batch."""
    frame = _labelled(spark, d)
    fitted = models.train_models(frame, features.LOG_FULL, {"tree": models.FULL_SETTINGS["tree"]})["tree"]
    path = work_folder(spark, "model")
    models.save_model(fitted, path)
    unknown = {c: F.when(F.col(c) == -1, None).otherwise(F.col(c)) for c in NUM[::2]}
    again = scoring.score_batch(frame.withColumns(unknown), models.load_model(path), features.LOG_FULL, ["listing_id"])
    first = scoring.score_batch(frame, fitted, features.LOG_FULL, ["listing_id"]).withColumnRenamed("predicted_price_per_m2", "first")
    return again.join(first, "listing_id").select("listing_id", (F.col("predicted_price_per_m2") == F.col("first")).alias("same"))


@query(
    "score_with_fallback",
    """SELECT f.listing_id, CASE WHEN f.listing_id % 3 = 0 THEN f.listing_id * 1000.0::DOUBLE ELSE estimate END AS price_per_m2,
    CASE WHEN f.listing_id % 3 = 0 THEN 'model' ELSE 'fallback' END AS source FROM fallback f""",
    "clean",
    more=_FALLBACK_SQL,
)
def _(spark, d):
    df = v.clean(spark, d)
    k = F.col("listing_id")
    predicted = df.select("listing_id", F.when(k % 3 == 0, k * 1000.0).alias("predicted_price_per_m2"))
    return scoring.score_with_fallback(predicted, _subjects(df), df, "listing_id")


@query("tune", "SELECT setting, true AS sound FROM (VALUES ('maxDepth=2'), ('maxDepth=5'), ('maxDepth=10')) AS t(setting)")
def _(spark, d):
    train, _test = _parts(spark, d)
    tried = models.tune(train, features.LOG_FULL, "tree", {"maxDepth": [2, 5, 10]})[1]
    return tried.select("setting", (F.col("rmse") > 0).alias("sound"))


@query(
    "prediction_interval",
    """SELECT listing_id, round(p - reach, 2) AS lower, round(p + reach, 2) AS upper FROM guesses,
    (SELECT quantile_cont(abs(price_per_m2 - p), 0.9) AS reach FROM guesses)""",
    "clean",
    more="guesses AS (SELECT listing_id, price_per_m2, price_per_m2 * (1 + (listing_id % 21 - 10) / 64.0::DOUBLE) AS p FROM clean)",
)
def _(spark, d):
    price = F.col("price_per_m2").cast("double")
    guesses = v.clean(spark, d).select(
        "listing_id", price.alias("price_per_m2"), (price * (1 + (F.col("listing_id") % 21 - 10) / 64.0)).alias("prediction")
    )
    spanned = scoring.prediction_interval(guesses, guesses, "price_per_m2")
    return _rounded(spanned.select("listing_id", "lower", "upper"), lower=2, upper=2)


_IN_TRAIN_SQL = "CAST('0x' || substr(md5(CAST(listing_id AS VARCHAR)), 1, 8) AS BIGINT) < 3435973837"


@query(
    "conformal_interval",
    """SELECT listing_id, round(p - coalesce(own, pooled), 2) AS lower, round(p + coalesce(own, pooled), 2) AS upper,
    CASE WHEN own IS NULL THEN 'pooled' ELSE 'group' END AS calibrated FROM guesses LEFT JOIN reaches USING (city_province),
    (SELECT r AS pooled FROM held QUALIFY row_number() OVER (ORDER BY r) = (9 * (count(*) OVER () + 1) + 9) // 10)""",
    "clean",
    more=f"""guesses AS (SELECT listing_id, city_province, price_per_m2, price_per_m2 * (1 + (listing_id % 21 - 10) / 64.0::DOUBLE) AS p FROM clean),
    held AS (SELECT city_province, abs(price_per_m2 - p) AS r FROM guesses WHERE NOT {_IN_TRAIN_SQL}),
    reaches AS (SELECT city_province, r AS own FROM held WHERE city_province IS NOT NULL QUALIFY count(*) OVER (PARTITION BY city_province) >= 30 AND
    row_number() OVER (PARTITION BY city_province ORDER BY r) = (9 * (count(*) OVER (PARTITION BY city_province) + 1) + 9) // 10)""",
)
def _(spark, d):
    """Calibrated on the test part, for every listing."""
    price = F.col("price_per_m2").cast("double")
    guess = price * (1 + (F.col("listing_id") % 21 - 10) / 64.0)
    guesses = v.clean(spark, d).select("listing_id", "city_province", price.alias("price_per_m2"), guess.alias("prediction"))
    held = guesses.filter(~ranking.in_train("listing_id"))
    spanned = scoring.conformal_interval(guesses, held, "price_per_m2", level=0.9, key="city_province", least=30)
    return _rounded(spanned.select("listing_id", "lower", "upper", "calibrated"), lower=2, upper=2)


# --- streams -------------------------------------------------------------------------------------------------


def _raw_stream(spark, d) -> DataFrame:
    orders = ingest.stream_files(spark, d, v.table(spark, d, "orders").schema, name_filter="orders.parquet")
    return v.raw_from_orders(orders, spark, d)


@query("stream_clean", f"SELECT {CLEAN_COLUMNS} FROM clean", "clean")
def _(spark, d):
    out = work_folder(spark, "stream-clean")
    ingest.append_available(ingest.stream_clean(_raw_stream(spark, d)), out, work_folder(spark, "progress")).awaitTermination()
    return v.widened(spark.read.parquet(out).drop("posting_ts"))


@query("stream_score", "SELECT listing_id, true AS same FROM clean", "clean")
def _(spark, d):
    """A stream's scores are those of the batch."""
    frame = _labelled(spark, d)
    fitted = models.train_models(frame, features.LOG_FULL, {"tree": models.FULL_SETTINGS["tree"]})["tree"]
    scored = ingest.stream_score(ingest.stream_clean(_raw_stream(spark, d)), fitted, features.LOG_FULL, ["listing_id"])
    out = work_folder(spark, "stream-score")
    ingest.append_available(scored, out, work_folder(spark, "progress")).awaitTermination()
    batch = scoring.score_batch(frame, fitted, features.LOG_FULL, ["listing_id"]).withColumnRenamed("predicted_price_per_m2", "batch")
    return spark.read.parquet(out).join(batch, "listing_id").select("listing_id", (F.col("predicted_price_per_m2") == F.col("batch")).alias("same"))


@query("stream_price_trend", "SELECT CAST(month(posting_ts) AS INTEGER) AS posting_month, avg(price_per_m2) AS avg_price FROM clean GROUP BY 1", "clean")
def _(spark, d):
    out = work_folder(spark, "stream-trend")
    totals = ingest.month_totals(ingest.stream_clean(_raw_stream(spark, d)), F.month("posting_ts"))
    ingest.publish_each_batch(totals, out, work_folder(spark, "progress")).awaitTermination()
    return ingest.month_means(ingest.read_published(spark, out))


def _twice(spark, d, name: str, parts: int = 3) -> str:
    """A folder with each part of a table's file twice, as if a delivery had been repeated."""
    out = work_folder(spark, f"{name}-twice")
    rows = v.table(spark, d, name).repartition(parts)
    rows.write.parquet(out)
    spark.read.parquet(out).write.mode("append").parquet(out)
    return out


@query("stream_clean_once", f"SELECT {CLEAN_COLUMNS} FROM clean", "clean")
def _(spark, d):
    """Files that arrive twice, one file in a batch: the result is that of the batch."""
    folder = _twice(spark, d, "orders")
    orders = ingest.stream_files(spark, folder, v.table(spark, d, "orders").schema, files_per_batch=1)
    cleaned = ingest.stream_clean_once(v.raw_from_orders(orders, spark, d), ["link", "posting_ts"], "posting_ts", late="5000 days")
    out = work_folder(spark, "stream-once")
    ingest.append_available(cleaned, out, work_folder(spark, "progress")).awaitTermination()
    return v.widened(spark.read.parquet(out).drop("posting_ts"))


@query(
    "stream_latest_status",
    """SELECT l_orderkey AS link_id, CASE l_returnflag WHEN 'A' THEN 'error' WHEN 'R' THEN 'failed' ELSE 'processed' END AS status
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC) = 1""",
)
def _(spark, d):
    """Status events one file at a time; the table has the latest status of each link."""
    folder, out = _twice(spark, d, "lineitem"), work_folder(spark, "stream-status")
    events = ingest.stream_files(spark, folder, v.table(spark, d, "lineitem").schema, files_per_batch=2)
    status = F.when(F.col("l_returnflag") == "A", "error").when(F.col("l_returnflag") == "R", "failed").otherwise("processed")
    events = events.select(F.col("l_orderkey").alias("link_id"), status.alias("status"), "l_shipdate", "l_linenumber", "l_partkey")
    order = ["l_shipdate", "l_linenumber", "l_partkey"]
    ingest.latest_each_batch(events, ["link_id"], order, out, work_folder(spark, "progress")).awaitTermination()
    return ingest.read_published(spark, out).select("link_id", "status")


@query(
    "stream_daily_totals",
    """SELECT strftime(date_trunc('day', posting_ts), '%Y-%m-%d') AS day, count(price_per_m2) AS priced, sum(price_per_m2) AS amount FROM clean
    WHERE date_trunc('day', posting_ts) + INTERVAL 1 DAY <= (SELECT max(posting_ts) FROM clean) - INTERVAL 30 DAY GROUP BY 1""",
    "clean",
)
def _(spark, d):
    out = work_folder(spark, "stream-days")
    days = ingest.day_totals(ingest.stream_clean(_raw_stream(spark, d)), "posting_ts")
    ingest.append_available(days, out, work_folder(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).withColumn("day", F.date_format("day", "yyyy-MM-dd"))

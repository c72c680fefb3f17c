"""Column layouts of the listing tables."""

from pyspark.sql import types as T


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


LISTINGS_RAW = _texts(
    "link", "title", "location", "price", "area", "category", "direction",
    "floor_num", "toilet_num", "street", "livingroom_num", "bedroom_num", "liability",
)

LISTING_DETAILS = _texts(
    "url", "description", "posting_date", "contact_name", "contact_phone", "features", "image_urls",
)

LISTINGS_CLEAN = T.StructType([
    T.StructField("price", T.FloatType()),
    T.StructField("area_m2", T.FloatType()),
    T.StructField("category", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("floor_num", T.IntegerType()),
    T.StructField("toilet_num", T.IntegerType()),
    T.StructField("livingroom_num", T.IntegerType()),
    T.StructField("bedroom_num", T.IntegerType()),
    T.StructField("liability", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("city_province", T.StringType()),
    T.StructField("street_width_m", T.FloatType()),
    T.StructField("price_per_m2", T.FloatType()),
])

# What a caller supplies to be priced.
SUBJECTS = T.StructType([
    T.StructField("city_province", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("liability", T.StringType()),
    T.StructField("area_m2", T.DoubleType()),
    T.StructField("bedroom_num", T.IntegerType()),
    T.StructField("floor_num", T.IntegerType()),
    T.StructField("toilet_num", T.IntegerType()),
    T.StructField("livingroom_num", T.IntegerType()),
    T.StructField("street_width_m", T.DoubleType()),
])

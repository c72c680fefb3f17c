"""Texts, limits and presets that decide the results. Kept together and in plain form."""

# Labels and sentinels.
UNKNOWN_LABEL = "Không xác định"
SAVE_MARKER = r"\s*Lưu tin\s*$"
MISSING_NUMBER = -1

# Price texts: unit words with their multipliers.
TOTAL_PRICE_UNITS = (("tỷ", 1e9), ("triệu", 1e6))
UNIT_PRICE_UNITS = (("triệu", 1e6), ("nghìn", 1e3))
NEGOTIABLE = "Thương lượng"
UNIT_PRICE_SUFFIX = r"\s*/m2$"
APPROX_MARK = "~"

# Suffixes of measured texts.
AREA_SUFFIX = r"\s*m2$"
FLOOR_SUFFIX = r"\s*tầng$"
BEDROOM_SUFFIX = r"\s*phòng$"

# Accepted price per square metre, VND, both ends included.
PRICE_PER_M2_BAND = (2e6, 1e8)

# Comparable listings: area strictly between these shares of the subject's area.
SIMILAR_AREA_SHARE = (0.7, 1.3)
COMPARABLES_SHOWN = 5
MIN_SIMILAR = 3
DEFAULT_PRICE_PER_M2 = 30_000_000.0

# Amount texts, largest unit first.
AMOUNT_UNITS = (("tỷ", 1_000_000_000), ("triệu", 1_000_000), ("nghìn", 1_000))
CURRENCY = "VND"

# Input limits of the prediction form, both ends included.
INPUT_LIMITS = {
    "area_m2": (10.0, 1000.0),
    "bedroom_num": (0, 10),
    "toilet_num": (0, 10),
    "livingroom_num": (0, 10),
    "floor_num": (0, 50),
    "street_width_m": (0.0, 50.0),
}
SMALL_AREA_M2 = 10.0

# Column groups.
COUNT_COLUMNS = ("floor_num", "toilet_num", "livingroom_num", "bedroom_num")
LABEL_COLUMNS = ("category", "direction", "liability", "location")
CATEGORICAL_FEATURES = ("category", "direction", "liability", "district", "city_province")
NUMERIC_FEATURES = (
    "area_m2",
    "floor_num",
    "toilet_num",
    "livingroom_num",
    "bedroom_num",
    "street_width_m",
)

# Candidate names for columns that are looked up by role.
LOCATION_CANDIDATES = ("province", "city", "location", "tinh_thanh", "thanh_pho", "district")
PRICE_CANDIDATES = ("price", "gia", "price_per_m2", "price_m2", "gia_tien", "total_price", "value")
AREA_CANDIDATES = ("area", "dien_tich", "area_m2", "square_meters", "dientich", "dt")

# Old and new spellings of two columns.
COLUMN_ALIASES = {"area (m2)": "area_m2", "street (m)": "street_width_m"}

# Cities with map positions (latitude, longitude).
CITY_POSITIONS = {
    "Hà Nội": (21.0285, 105.8542),
    "Hồ Chí Minh": (10.8231, 106.6297),
    "Đà Nẵng": (16.0544, 108.2022),
    "Hải Phòng": (20.8449, 106.6881),
    "Cần Thơ": (10.0452, 105.7469),
    "Nha Trang": (12.2388, 109.1967),
    "Huế": (16.4637, 107.5909),
    "Vũng Tàu": (10.3461, 107.0842),
}

# Worklist statuses.
STATUS_DONE = "processed"
STATUS_RETRY = ("failed", "error")

# Marks of page elements that hold a field: (tag, class fragment, which match).
LISTING_PAGE_FIELDS = {
    "title": ("h1", "head-title", 1),
    "price": ("div", "infor-note", 2),
    "area": ("div", "infor-data", 2),
}
# Class of the element that the field's element must be a child of.
LISTING_PAGE_PARENTS = {"price": "col-item", "area": "col-item"}
LISTING_LOCATION_STYLE = "float:left; width:87%; padding-left: 5px;"
LISTING_OPTION_CLASSES = {
    "category": "opt-mattien",
    "direction": "opt-huongnha",
    "floor_num": "opt-sotang",
    "toilet_num": "opt-sotoilet",
    "street": "opt-duong",
    "livingroom_num": "opt-bancong",
    "bedroom_num": "opt-sopngu",
    "liability": "opt-phaply",
}
OPTION_VALUE_CLASS = "value-item"
INDEX_LIST_CLASS = "property-list"
INDEX_ITEM_CLASS = "row-item"
DETAIL_PAGE_FIELDS = {
    "description": "description-content",
    "posting_date": "posting-date",
    "contact_name": "contact-name",
    "contact_phone": "contact-phone",
}
FEATURES_CLASS = "features"
CAROUSEL_CLASS = "carousel"
AMENITY_KINDS = ("schools", "hospitals", "markets", "parks", "bus_stations")

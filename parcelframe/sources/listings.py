"""Readers for listing tables. Any path may be a glob and may use any Hadoop file system URI."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelframe import schemas

# pandas and Spark both double a quote inside a quoted field when told so.
_CSV = {"header": "true", "encoding": "UTF-8", "escape": '"'}
_LINE = "_corrupt_line"


def _options(many_lines: bool) -> dict[str, str]:
    """A file whose fields may hold line ends cannot be split: it is read by one task. Others are read in parts."""
    return {**_CSV, "multiLine": str(many_lines).lower()}


def _by_name(spark: SparkSession, path: str, schema: T.StructType, many_lines: bool) -> DataFrame:
    """Columns are taken by the header's names, in any order; those that the files lack are null, others are left out.

    Files of one call must have the same header: it is compared for each of them, and a difference fails.
    """
    header = spark.read.options(**_options(many_lines)).csv(path).schema
    found = spark.read.schema(header).options(**_options(many_lines), enforceSchema="false").csv(path)
    return found.select(*[(F.col(f"`{f.name}`") if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def read_listings(spark: SparkSession, path: str, many_lines: bool = False) -> DataFrame:
    """Headered CSV of scraped listings, every column text, blank fields null."""
    return _by_name(spark, path, schemas.LISTINGS_RAW, many_lines)


def read_details(spark: SparkSession, path: str, many_lines: bool = False) -> DataFrame:
    return _by_name(spark, path, schemas.LISTING_DETAILS, many_lines)


def read_clean(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = schemas.LISTINGS_CLEAN
) -> DataFrame:
    """The cleaned table with its types; a CSV never passes through inference."""
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "csv":
        return _by_name(spark, path, schema, many_lines=False)
    raise ValueError(f"unsupported format {fmt!r}")


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType = schemas.LISTINGS_RAW
) -> tuple[DataFrame, DataFrame]:
    """Headered CSV as (good rows, quarantined rows); every line is in one of the two.

    A line is quarantined if it has more or fewer fields than the header, or a field that its type in the schema cannot read.
    Quarantined rows are (file, line, reason), the reason being ``open_quote``, ``too_few_fields``, ``too_many_fields`` or
    ``unreadable_value``. Columns are taken by the header's names, those that the schema lacks are left out, and those that the
    files lack are null. Fields must not hold line ends. Blank lines are skipped. Both tables read the files in parts, in one pass each.
    """
    header = spark.read.options(**_options(False)).csv(path).schema
    types = {f.name: f.dataType for f in schema}
    known = T.StructType([T.StructField(f.name, types.get(f.name, T.StringType())) for f in header])
    # Without all columns before it the parser cannot tell a short line from a whole one.
    options = {**_options(False), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "columnPruning": "false", "enforceSchema": "false"}
    rows = spark.read.schema(T.StructType([*known, T.StructField(_LINE, T.StringType())])).options(**options).csv(path)
    # True for every row, but it has all fields read, whatever the caller selects: unread ones would not be judged.
    rows = rows.filter(F.hash(*[F.col(f"`{name}`") for name in header.names]) >= -(2**31))
    good = rows.filter(F.col(_LINE).isNull()).select(
        *[(F.col(f"`{f.name}`") if f.name in header.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )
    bare = F.regexp_replace(_LINE, '"([^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = (
        F.when(F.contains(bare, F.lit('"')), "open_quote")
        .when(fields < len(header), "too_few_fields")
        .when(fields > len(header), "too_many_fields")
        .otherwise("unreadable_value")
    )
    bad = rows.filter(F.col(_LINE).isNotNull()).select(F.input_file_name().alias("file"), F.col(_LINE).alias("line"), reason.alias("reason"))
    return good, bad


def quarantine_counts(quarantined: DataFrame) -> DataFrame:
    """Lines per file and reason."""
    return quarantined.groupBy("file", "reason").agg(F.count("*").alias("lines"))


def read_storage(spark: SparkSession, path: str, many_lines: bool = False) -> DataFrame:
    """Headered CSV from a distributed file system, columns as text named by the header."""
    return spark.read.options(**_options(many_lines)).csv(path)


def read_inferred(spark: SparkSession, path: str, many_lines: bool = False) -> DataFrame:
    """Headered CSV with inferred types; one extra pass over the data, meant for unknown files."""
    return spark.read.options(**_options(many_lines), inferSchema="true").csv(path)


def rows_to_frame(spark: SparkSession, rows, schema: T.StructType = schemas.SUBJECTS) -> DataFrame:
    """One dict, a list of dicts or rows, or a pandas frame as a typed table; absent keys become null."""
    if isinstance(rows, dict):
        rows = [rows]
    if isinstance(rows, list) and rows and isinstance(rows[0], dict):
        rows = [tuple(row.get(name) for name in schema.names) for row in rows]
    return spark.createDataFrame(rows, schema)


def worklist_links(listings: DataFrame, link: str = "link", distinct: bool = False) -> DataFrame:
    """The links to visit; duplicates stay unless ``distinct`` is set."""
    links = listings.select(F.col(link))
    return links.distinct() if distinct else links

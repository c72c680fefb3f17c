"""Links to visit, their status log and the join of listings with their details."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe import fixed


def latest_by(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row per key in the given order, which must not tie.

    A maximum, not a window: each task first reduces its own rows, so a key with very many rows does
    not have to be sorted in one place.
    """
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def latest_status(log: DataFrame, link: str = "link", order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Current status per link of an append-only log."""
    return latest_by(log.select(link, "status", *order), link, order).select(link, "status")


def pending_links(listings: DataFrame, log: DataFrame, link: str = "link", order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """Distinct links not yet processed; failed ones and ones with an error are tried again."""
    done = latest_status(log, link, order).filter(F.col("status") == fixed.STATUS_DONE)
    return listings.select(link).distinct().join(done, link, "left_anti")


def listing_details_join(
    listings: DataFrame, details: DataFrame, order: Sequence[str], link: str = "link", url: str = "url"
) -> DataFrame:
    """Every listing with the latest details stored for its link, nulls where there are none."""
    latest = latest_by(details, url, order).withColumnRenamed(url, link)
    return listings.join(latest, link, "left")


def mask_contacts(df: DataFrame, columns: Sequence[str] = ("contact_name", "contact_phone")) -> DataFrame:
    """Contact data hidden for previews."""
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.lit("***")) for c in columns})

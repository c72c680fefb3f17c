"""Registered queries beside their SQL on the smallest data; ALL_QUERIES=1 runs every one of them."""

import os

import pytest

from checks import catalog, compare

CHOSEN = (
    "scan_listings_csv extract_page_fields extract_links clean_listings_a clean_listings_b prepare_model_frame "
    "trim_p99_sequential validate_listing comparables_join comparables_top5 fallback_estimate city_map_stats "
    "listing_details_join pending_links region_overview corr_matrix price_histogram price_kde price_boxplot_by_city "
    "area_price_points string_index regression_metrics stream_clean stream_daily_totals"
).split()


@pytest.fixture(scope="module")
def connection(data):
    return compare.connect(data)


@pytest.mark.parametrize("name", list(catalog.SQL) if os.environ.get("ALL_QUERIES") else CHOSEN)
def test_query_equals_sql(spark, data, connection, name):
    assert compare.differences(catalog.QUERIES[name](spark, data), connection, catalog.SQL[name]) == []


def test_every_sql_has_its_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)

"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog  # noqa: E402
from parcelframe.session import build_session, release  # noqa: E402

HEADLINE = (
    "scan_clean extract_page_fields extract_links clean_listings_a clean_listings_b prepare_model_frame impute_median "
    "filter_price_range trim_p99_joint validate_listing comparables_join comparables_top5 fallback_estimate city_map_stats "
    "listing_details_join latest_status pending_links quick_stats price_summary avg_price_by_city avg_price_by_district "
    "median_price_by_city region_overview corr_matrix price_quantiles price_histogram price_kde price_boxplot_by_city "
    "monthly_price_trend area_price_points train_test_split string_index standardize regression_metrics train_linear "
    "score_with_fallback stream_clean stream_price_trend train_tree score_batch extract_listing_fields extract_details"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds = round(time.perf_counter() - started, 3)
        release(spark)
        return seconds

    run("avg_price_by_city")  # start-up and class loading are not a query
    chosen = sys.argv[1:] or HEADLINE
    seconds = {name: run(name) for name in chosen}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

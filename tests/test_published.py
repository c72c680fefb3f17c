"""Published tables, quantiles of long numbers, merged sketches, and rows that were lost or spoiled results."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelframe.operators import distributions, quantiles, ranking, sketches
from parcelframe.session import work_folder
from parcelframe.streaming import ingest


def test_readers_keep_what_they_had_when_a_write_fails(spark):
    out = work_folder(spark, "published")
    assert ingest.published_version(spark, out) is None
    ingest.publish(spark.range(5), out, "one")
    before, first = ingest.read_published(spark, out), ingest.published_version(spark, out)
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        ingest.publish(broken, out, "two")
    assert ingest.published_version(spark, out) == first and ingest.read_published(spark, out).count() == 5
    ingest.publish(spark.range(7), out, "three")
    assert ingest.read_published(spark, out).count() == 7 and before.count() == 5
    ingest.publish(spark.range(8), out, "four")
    assert ingest.read_published(spark, out).count() == 8


def test_latest_rows_of_several_batches_with_null_keys(spark):
    folder = work_folder(spark, "events")
    parts = [[("a", 1, "x"), (None, 1, "p")], [("a", 3, "z"), ("b", 1, "y")], [("a", 2, "w"), (None, 2, "q")]]
    schema = "link string, seq int, status string"
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    events = ingest.stream_files(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
    out = work_folder(spark, "latest")
    ingest.latest_each_batch(events, ["link"], ["seq"], out, work_folder(spark, "progress")).awaitTermination()
    got = {(r.link, r.seq, r.status) for r in ingest.read_published(spark, out).collect()}
    assert got == {("a", 3, "z"), ("b", 1, "y"), (None, 2, "q")}


def by_hand(values, p):
    values = sorted(values)
    at = Decimal(p) * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low, high, Decimal(low) + (Decimal(high) - Decimal(low)) * (at - int(at))


def test_long_numbers_keep_every_digit(spark):
    rows = [("a", 9007199254740993), ("a", 9007199254740992), ("a", 9007199254740995), ("b", -(2**63)), ("b", 2**63 - 1), ("c", None), (None, 4)]
    df = spark.createDataFrame(rows, "k string, x long")
    got = {r.k: r for r in quantiles.exact_decimal_quantiles(df, "x", {"m": "0.5"}, ["k"]).collect()}
    assert set(got) == {"a", "b"} and got["a"].m == 9007199254740993
    assert (got["b"].m_low, got["b"].m_high, got["b"].m) == (-(2**63), 2**63 - 1, Decimal("-0.5"))
    none = quantiles.exact_decimal_quantiles(df.filter("k = 'c'"), "x", {"m": "0.5"}).collect()
    assert [(r.m, r.m_low) for r in none] == [(None, None)]
    with pytest.raises(TypeError, match="whole numbers"):
        quantiles.exact_decimal_quantiles(df.withColumn("x", F.lit(1.0)), "x", {"m": "0.5"})


@pytest.mark.parametrize("values", [[0, 1], [10**33, -(10**33), *range(40), *[7] * 30], [5]])
def test_decimal_quantiles_equal_a_sorted_list(spark, values):
    df = spark.createDataFrame([(Decimal(x) / 100,) for x in values], "x decimal(38,2)")
    row = quantiles.exact_decimal_quantiles(df, "x", {"p10": "0.1", "p90": "0.9"}).first()
    for name, p in (("p10", "0.1"), ("p90", "0.9")):
        low, high, between = by_hand([Decimal(x) / 100 for x in values], p)
        assert (row[f"{name}_low"], row[f"{name}_high"]) == (low, high) and abs(row[name] - between) <= Decimal("0.0001")


def test_merged_sketches_are_near_the_rank(spark):
    df = spark.range(60_000).selectExpr("id % 7 as place", "id % 12 as month", "cast(pow(id % 9973, 2) as double) as x")
    df = df.unionByName(spark.createDataFrame([(1, 1, float("nan")), (1, 1, None)], "place long, month long, x double"))
    fine = sketches.quantile_sketches(df, "x", ["place", "month"])
    merged = sketches.sketched_quantiles(sketches.merged_sketches(fine), {"p50": 0.5, "p90": 0.9}).first()
    assert merged.rows == 60_000
    for p, value in ((0.5, merged.p50), (0.9, merged.p90)):
        below = df.filter(f"not isnan(x) and x < {value}").count() / 60_000
        upto = df.filter(f"not isnan(x) and x <= {value}").count() / 60_000
        assert below - 0.01 <= p <= upto + 0.01


def test_rows_without_a_key_are_test_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "k long")
    train, test = ranking.train_test_split(df, "k")
    assert train.count() + test.count() == 4 and test.filter("k is null").count() == 2


def test_nan_is_left_out_of_charts(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (4.0,), (None,)], "x double")
    bins = distributions.histogram(df, "x", bins=3).collect()
    assert [(r.low, r.count if isinstance(r.count, int) else r["count"]) for r in bins] == [(1.0, 1), (2.0, 1), (3.0, 1)]
    assert all(r.density > 0 for r in distributions.density(df, "x", points=5).collect())


def test_a_repeated_delivery_is_cleaned_once(spark):
    folder = work_folder(spark, "orders")
    schema = "link string, location string, price string, area string, posting_ts timestamp, title string, category string, direction string, floor_num string, toilet_num string, street string, livingroom_num string, bedroom_num string, liability string"
    row = ("u1", "D, C", "1 tỷ", "50 m2", None, *[None] * 9)
    df = spark.createDataFrame([row, ("u2", *row[1:])], schema).withColumn("posting_ts", F.lit("2024-05-01").cast("timestamp"))
    for _ in range(3):
        df.coalesce(1).write.mode("append").parquet(folder)
    stream = ingest.stream_files(spark, folder, df.schema, files_per_batch=1)
    out = work_folder(spark, "once")
    ingest.append_available(ingest.stream_clean_once(stream, ["link", "posting_ts"], "posting_ts"), out, work_folder(spark, "progress")).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_large_keys_keep_every_digit(spark, tmp_path):
    from checks import catalog

    keys = [1, 59_941, 59_942, 150_000, 9_000_000, 2**62, 2**63 - 1]
    rows = spark.createDataFrame([(k, "a", 1.0) for k in keys] + [(None, "a", 1.0)], "o_orderkey long, o_orderstatus string, o_totalprice double")
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    row = catalog.QUERIES["exact_bigint_quantiles"](spark, str(tmp_path)).first()
    values = [k * 153722867280912 + 9007199254740993 for k in keys]
    for name, p in (("p25", "0.25"), ("p50", "0.50"), ("p99", "0.99")):
        assert (row[f"{name}_low"], row[f"{name}_high"]) == by_hand(values, p)[:2]


def test_latest_rows_keep_no_state_of_the_stream(spark):
    folder, out, progress = (work_folder(spark, name) for name in ("events", "latest", "progress"))
    schema = "link string, seq int, status string"
    for rows in ([("a", 2, "x"), (None, None, "p")], [("a", 1, "z"), (None, 1, "q"), ("b", None, "y")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    events = ingest.stream_files(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
    query = ingest.latest_each_batch(events, ["link"], ["seq"], out, progress)
    query.awaitTermination()
    assert not query.lastProgress["stateOperators"]
    assert {tuple(r) for r in ingest.read_published(spark, out).collect()} == {("a", 2, "x"), (None, 1, "q"), ("b", None, "y")}

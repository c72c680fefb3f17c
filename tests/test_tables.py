"""Readers, writers, schema lookup, worklist and validation."""

import pytest
from pyspark.sql import functions as F

from parcelframe import fixed, schemas
from parcelframe.operators import columns as cols
from parcelframe.operators import filters, ranking, stats, worklist
from parcelframe.plans import cleaning, reports
from parcelframe.sources import listings, sinks


def _raw(spark):
    rows = [
        ("l1", 'say "hi", all', "so 1, Q1, HCM Lưu tin", "2 tỷ", "100 m2", "house", "Đông", "2 tầng", "2", "6-8m", "1", "3 phòng", "red"),
        ("l2", "two\nlines", "HCM", "800 triệu", "80 m2", "house", None, None, None, None, None, None, None),
        ("l3", "t", None, "Thương lượng", "80 m2", "house", None, None, None, None, None, None, None),
        ("l4", "t", "Q1, HN", "9 tỷ", "0 m2", "house", None, None, None, None, None, None, None),
        ("l5", "t", "Q1, HN", None, "10 m2", "house", None, None, None, None, None, None, None),
        ("l6", "t", "Q1, HN", "900 tỷ", "10 m2", "house", None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, schemas.LISTINGS_RAW)


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_table(_raw(spark), path, single_file=True)
    assert len(list((tmp_path / "raw").glob("*.csv"))) == 1
    assert sorted(listings.read_listings(spark, path, many_lines=True).collect()) == sorted(_raw(spark).collect())
    assert listings.read_storage(spark, path).columns == schemas.LISTINGS_RAW.names
    assert dict(listings.read_inferred(spark, path, many_lines=True).dtypes)["toilet_num"] == "int"


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("title,extra,link\nT1,x,l1\n", encoding="utf-8")
    row = listings.read_listings(spark, str(tmp_path / "in")).first()
    assert (row["link"], row["title"], row["price"]) == ("l1", "T1", None)
    (tmp_path / "in" / "b.csv").write_text("link,extra,title\nl2,x,T2\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        listings.read_listings(spark, str(tmp_path / "in")).collect()


def test_work_folders_are_released(spark):
    from parcelframe import session

    session.release(spark)
    path = session.work_folder(spark, "test")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert session.release(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_small_test_parts(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    train, test = ranking.train_test_split(rows, "k", 0.995)
    assert 50 < test.count() < 150 and train.count() + test.count() == 20_000
    assert ranking.sample_n(rows, "k", 7).count() == 7 and ranking.sample_n(rows.limit(3), "k", 7).count() == 3


def test_csv_with_byte_order_mark(spark, tmp_path):
    file = tmp_path / "bom.csv"
    file.write_text("link,title\nl1,Nhà\n", encoding="utf-8-sig")
    assert listings.read_storage(spark, str(file)).columns == ["link", "title"]


def test_clean_a(spark, tmp_path):
    cleaned = cleaning.clean_listings_a(_raw(spark))
    assert set(cleaned.columns) == set(schemas.LISTINGS_CLEAN.names)
    assert {f.name: f.dataType for f in cleaned.schema} == {f.name: f.dataType for f in schemas.LISTINGS_CLEAN}
    rows = {r["area_m2"]: r for r in cleaned.collect()}
    assert set(rows) == {100.0, 80.0}
    assert rows[100.0]["price_per_m2"] == 2e7 and rows[100.0]["street_width_m"] == 7.0
    assert (rows[80.0]["district"], rows[80.0]["city_province"]) == (None, "HCM")
    assert (rows[80.0]["floor_num"], rows[80.0]["direction"]) == (-1, fixed.UNKNOWN_LABEL)
    path = str(tmp_path / "clean")
    sinks.write_clean(cleaned.select(*schemas.LISTINGS_CLEAN.names), path)
    again = listings.read_clean(spark, path, "csv")
    assert again.schema["price"].dataType.simpleString() == "float" and again.count() == 2


def test_clean_b_keeps_what_a_drops(spark):
    rows = cleaning.clean_listings_b(_raw(spark)).collect()
    assert sorted(r["price_per_m2"] for r in rows) == [8e8]


def test_append_and_formats(spark, tmp_path):
    path = str(tmp_path / "details")
    row = ("u", "d", "01/02/2020", "n", "p", "a|b", "i")
    details = spark.createDataFrame([row], schemas.LISTING_DETAILS)
    sinks.append_details(details, path)
    sinks.append_details(details, path)
    assert [tuple(r) for r in listings.read_details(spark, path).collect()] == [row, row]
    with pytest.raises(ValueError):
        sinks.write_table(details, path, "text")
    with pytest.raises(ValueError):
        listings.read_clean(spark, path, "orc")


def test_rows_to_frame(spark):
    one = listings.rows_to_frame(spark, {"city_province": "HN", "area_m2": 50.0})
    assert one.schema == schemas.SUBJECTS and one.first()["district"] is None


def test_column_lookup(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "n int, district string, `area (m2)` double")
    assert cols.resolve_column(df, fixed.LOCATION_CANDIDATES) == "district"
    assert cols.resolve_column(df, fixed.PRICE_CANDIDATES, numeric_fallback=True) == "n"
    assert cols.resolve_column(df, ["none"], other_than=["n"]) == "district"
    assert cols.numeric_columns(df) == ["n", "area (m2)"] and cols.numeric_columns(df, 1) == ["n"]
    both = cols.alias_columns(df)
    assert both.first()["area_m2"] == 2.0
    assert cols.add_placeholders(df, {"n": 9, "flag": 0}).first()["n"] == 1


def test_cleaned_rows_pass_their_own_filters(spark):
    cleaned = cleaning.clean_listings_a(_raw(spark))
    again = filters.filter_price_per_m2_band(filters.filter_area_positive(filters.filter_price_present(cleaned), "area_m2"))
    assert again.count() == cleaned.count()


def test_validation(spark):
    row = {"city_province": "HN", "district": "Q", "category": "c", "direction": "d", "liability": "l"}
    good = {**row, "area_m2": 50.0, "bedroom_num": 1, "floor_num": 1, "toilet_num": 1, "livingroom_num": 1, "street_width_m": 4.0}
    bad = {**good, "area_m2": -1.0, "floor_num": 51, "district": None}
    checked = filters.validate_listing(listings.rows_to_frame(spark, [good, bad])).collect()
    assert checked[0]["is_valid"] and checked[0]["errors"] == []
    assert checked[1]["errors"] == ["missing:district", "area_not_positive", "out_of_range:area_m2", "out_of_range:floor_num"]
    assert checked[1]["warnings"] == ["area_too_small"]


def test_latest_status_and_pending(spark):
    log = spark.createDataFrame([("a", "error", 1, 1), ("a", "processed", 2, 1), ("b", "processed", 1, 1), ("b", "failed", 1, 2)], "link string, status string, ts int, seq int")
    assert {tuple(r) for r in worklist.latest_status(log).collect()} == {("a", "processed"), ("b", "failed")}
    listed = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "link string")
    assert {r[0] for r in worklist.pending_links(listed, log).collect()} == {"b", "c"}
    shown = worklist.mask_contacts(spark.createDataFrame([("An", None)], "contact_name string, contact_phone string")).first()
    assert tuple(shown) == ("***", None)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    train, test = ranking.train_test_split(df, "id")
    again, _ = ranking.train_test_split(df.repartition(7), "id")
    assert train.count() + test.count() == 2000
    assert abs(train.count() - 1600) < 80
    assert train.exceptAll(again).count() == 0


def test_observed_count_needs_no_extra_job(spark):
    df, seen = stats.observed_count(_raw(spark), "raw", ["price"])
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 6, "price_nulls": 1}


def test_reports_are_written(spark, data, tmp_path):
    from checks import views

    cleaned = views.clean(spark, data).cache()
    tables = reports.chart_tables(cleaned, "listing_id")
    chosen = {name: tables[name] for name in ("price_histogram", "price_by_bedroom_num")}
    sinks.write_reports(chosen, str(tmp_path))
    stored = spark.read.parquet(str(tmp_path / "price_histogram"))
    assert stored.agg(F.sum("count")).first()[0] == cleaned.count()
    cleaned.unpersist()

"""Broken lines, single files, replaced partitions, counted steps, binned densities and conformal intervals."""

import math
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelframe.operators import distributions, filters, quantiles
from parcelframe.plans import cleaning, scoring
from parcelframe.session import work_folder
from parcelframe.sources import listings, sinks

TYPED = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("more", T.DoubleType())])


def text_file(spark, lines):
    folder = work_folder(spark, "lines")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(folder)
    return folder


def test_every_line_is_good_or_quarantined(spark):
    lines = ['n,name,other', '1,a,x', '2,"b, ""c""",x', '3,d', '4,e,x,y', 'five,f,x', '6,,', '7,"open,x', '', '8,g"h,x']
    good, bad = listings.read_checked(spark, text_file(spark, lines), TYPED)
    assert good.schema.names == ["name", "n", "more"]
    assert {(r.n, r.name, r.more) for r in good.collect()} == {(1, "a", None), (2, 'b, "c"', None), (6, None, None), (8, 'g"h', None)}
    found = {r.line: r.reason for r in bad.collect()}
    assert found == {"3,d": "too_few_fields", "4,e,x,y": "too_many_fields", "five,f,x": "unreadable_value", '7,"open,x': "open_quote"}
    counts = {(r.reason, r.lines) for r in listings.quarantine_counts(bad).collect()}
    assert counts == {(reason, 1) for reason in found.values()}
    # Good rows alone, of few columns, are judged by the whole line as well.
    assert good.select("name").count() == 4


def test_a_file_of_a_header_only_has_no_rows(spark):
    good, bad = listings.read_checked(spark, text_file(spark, ["n,name"]), TYPED)
    assert good.count() == 0 and bad.count() == 0


def read_text(path):
    with open(path.removeprefix("file:"), encoding="utf-8") as file:
        return file.read()


def test_a_single_file_equals_that_of_one_task(spark, tmp_path):
    df = spark.range(1000, numPartitions=12).selectExpr("id", "concat('a, \"b\" ', id) as `odd, name`", "if(id % 3 = 0, null, '') as empty")
    sinks.write_single_csv(df, f"{tmp_path}/all.csv")
    sinks.write_table(df, f"{tmp_path}/one", single_file=True)
    one = next(f for f in os.listdir(f"{tmp_path}/one") if f.startswith("part-"))
    assert read_text(f"{tmp_path}/all.csv") == read_text(f"{tmp_path}/one/{one}")
    sinks.write_single_csv(df.limit(0), f"{tmp_path}/all.csv")
    assert read_text(f"{tmp_path}/all.csv") == 'id,"odd, name",empty\n'
    assert [f for f in os.listdir(tmp_path) if "writing" in f and not f.endswith(".crc")] == []


def test_a_failed_single_file_leaves_the_old_one(spark, tmp_path):
    path = f"{tmp_path}/all.csv"
    sinks.write_single_csv(spark.range(3), path)
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_single_csv(broken, path)
    assert read_text(path) == "id\n0\n1\n2\n"


def files_of(path):
    return {(root, f): os.stat(os.path.join(root, f)).st_mtime_ns for root, _d, files in os.walk(path) for f in files if f.startswith("part-")}


def test_one_place_is_replaced_and_the_others_stay(spark, tmp_path):
    path = f"{tmp_path}/places"
    df = spark.range(90).selectExpr("id", "elt(1 + id % 3, 'Huế', 'Hà Nội', null) as city_province", "id % 7 as district")
    sinks.replace_partitions(df, path, ["city_province"])
    before = files_of(path)
    sinks.replace_partitions(df.filter("city_province = 'Huế' and id < 10"), path, ["city_province"])
    after = files_of(path)
    kept = {f: t for f, t in before.items() if "Hu" not in f[0]}
    assert kept and kept.items() <= after.items() and not any(f in after for f in before if f not in kept)
    table = spark.read.schema(df.schema).parquet(path)
    assert {(r.city_province, r["count"]) for r in table.groupBy("city_province").count().collect()} == {("Huế", 4), ("Hà Nội", 30), (None, 30)}


def plan(df):
    return df._jdf.queryExecution().toString()


def test_a_place_prunes_its_folders(spark, tmp_path):
    path = f"{tmp_path}/places"
    df = spark.range(3000).selectExpr("id", "concat('city ', id % 10) as city_province", "id % 7 as district")
    sinks.replace_partitions(df, path, ["city_province"])
    table = spark.read.schema(df.schema).parquet(path)
    one = filters.filter_location(table, "city 3")
    assert "PartitionFilters: [isnotnull(city_province" in plan(one) and len(one.inputFiles()) > 0
    assert one.count() == 300
    # A filtered table of places prunes the folders of the listings it is joined to while the query runs.
    places = table.groupBy("city_province").agg(F.max("id").alias("last")).filter("last >= 2998")
    found = table.join(places, "city_province", "left_semi")
    assert "dynamicpruning" in plan(found) and found.count() == 600


def test_steps_are_counted_by_the_job_that_writes(spark):
    names = ["location", "price", "area", "category", "direction", "floor_num", "toilet_num", "street", "livingroom_num", "bedroom_num", "liability"]
    cells = [("1 tỷ", "50 m2"), (None, "50 m2"), ("1 tỷ", None), ("Thương lượng", "50 m2"), ("1 tỷ", "0 m2"), ("1 tỷ", "5 km"), ("1 tỷ", "1 m2")]
    raw = spark.createDataFrame([("D, C", p, a, *[None] * 8) for p, a in cells], ", ".join(f"{n} string" for n in names))
    cleaned, counts = cleaning.with_step_counts(raw)
    assert len(cleaned.collect()) == 1
    got = [(r.step, r.rows, r.dropped) for r in counts().orderBy("place").collect()]
    assert got == [("read", 7, 0), ("with_texts", 5, 2), ("priced", 4, 1), ("with_area", 2, 2), ("in_band", 1, 1)]
    other, counts = cleaning.with_step_counts(raw.replace("1 tỷ", "20 triệu/m2", "price"), cleaning.clean_listings_b)
    assert len(other.collect()) == 4
    assert [(r.step, r.rows) for r in counts().orderBy("place").collect()] == [("read", 7), ("with_texts", 5), ("priced", 4)]
    empty, counts = cleaning.with_step_counts(raw.limit(0))
    assert empty.collect() == [] and {r.rows for r in counts().collect()} == {0}


@pytest.mark.parametrize(
    "value", ["sin(id) * 100", "exp(pmod(hash(id), 1000) / 200.0)", "if(id = 0, 1e6, sqrt(id))", "id % 3"], ids=["waves", "skewed", "outlier", "few"]
)
def test_a_binned_density_is_near_the_direct_one(spark, value):
    df = spark.range(4000).selectExpr(f"cast({value} as double) as x")
    df = df.unionByName(spark.createDataFrame([(float("nan"),), (None,)], "x double"))
    direct = [r.density for r in distributions.density(df, "x").orderBy("point").collect()]
    binned = distributions.binned_density(df, "x").orderBy("point").collect()
    assert [r.point for r in binned] == list(range(200))
    assert max(abs(a - b.density) for a, b in zip(direct, binned, strict=True)) <= 1e-4 * max(direct)
    assert distributions.binned_density(df.filter("x is null"), "x").count() == 0
    assert distributions.binned_density(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x").count() == 0


def test_places_by_expression(spark):
    df = spark.range(10).selectExpr("cast(id * id as double) as x", "id % 2 as k")
    got = {r.k: (r.third, r.none) for r in quantiles.exact_quantiles(df, "x", {"third": "2", "none": "_total"}, ["k"]).collect()}
    assert got == {0: (16.0, None), 1: (25.0, None)}


def by_hand(values, level):
    values = sorted(values)
    rank = math.ceil((len(values) + 1) * level)
    return values[rank - 1] if rank <= len(values) else None


def test_conformal_reaches_are_order_statistics(spark):
    rows = [("a", float(x * x % 101), 0.0) for x in range(59)] + [("b", float(x), 1.0) for x in range(4)] + [(None, 7.0, 0.5), ("a", None, 1.0), ("a", float("nan"), 0.0)]
    held = spark.createDataFrame(rows, "city string, y double, guess double")
    new = spark.createDataFrame([("a", 10.0), ("b", 20.0), (None, 30.0), ("c", 40.0)], "city string, guess double")
    residuals = [(c, abs(y - g)) for c, y, g in rows if y is not None and y == y]
    pooled, own = by_hand([r for _c, r in residuals], 0.75), by_hand([r for c, r in residuals if c == "a"], 0.75)
    got = {r.guess: (r.lower, r.upper, r.calibrated) for r in scoring.conformal_interval(new, held, "y", "guess", 0.75, "city", least=10).collect()}
    assert got[10.0] == (10 - own, 10 + own, "group")
    assert all(got[g] == (g - pooled, g + pooled, "pooled") for g in (20.0, 30.0, 40.0))
    few = scoring.conformal_interval(new, held.limit(3), "y", "guess", 0.9).collect()
    assert {(r.lower, r.upper) for r in few} == {(-math.inf, math.inf)}
    none = scoring.conformal_interval(new, held.limit(0), "y", "guess", 0.9, "city").collect()
    assert {(r.upper, r.calibrated) for r in none} == {(math.inf, "pooled")}


def test_intervals_cover_a_third_part(spark):
    df = spark.range(6000).selectExpr("id", "pmod(hash(id), 2000) / 10.0 as guess", "concat('c', id % 3) as city")
    df = df.selectExpr("*", "guess + (1 + id % 3 * 4) * sin(hash(id, 'noise')) as y")
    held, new = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    spanned = scoring.conformal_interval(new, held, "y", "guess", 0.9, "city")
    shares = spanned.groupBy("city").agg(F.avg(F.col("y").between(F.col("lower"), F.col("upper")).cast("int")).alias("share")).collect()
    assert len(shares) == 3 and all(0.87 <= r.share <= 0.94 for r in shares)

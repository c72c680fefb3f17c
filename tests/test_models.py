import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from checks import views
from parcelframe.operators import ranking
from parcelframe.plans import cleaning, features, models, scoring
from parcelframe.streaming import ingest

SMALL = {"tree": {"maxDepth": 3}, "linear": {"maxIter": 5}}


@pytest.fixture(scope="module")
def parts(spark, data):
    frame = views.model_frame(spark, data).cache()
    yield ranking.train_test_split(frame, "listing_id")
    frame.unpersist()


@pytest.fixture(scope="module")
def trained(parts):
    train, test = parts
    return models.train_and_choose(train, test, features.LOG_FULL, SMALL)


def test_metrics_agree_with_the_evaluator(parts, trained):
    _, fitted, metrics = trained
    values = {(r["model"], r["metric"]): r["value"] for r in metrics.collect()}
    priced = fitted["tree"].transform(parts[1]).withColumn("p", F.expm1("prediction"))
    for metric in ("rmse", "mse", "mae", "r2"):
        expected = RegressionEvaluator(labelCol="price_per_m2", predictionCol="p", metricName=metric).evaluate(
            priced.withColumn("price_per_m2", F.col("price_per_m2").cast("double"))
        )
        assert values["tree", metric.upper()] == pytest.approx(expected, rel=1e-9)


def test_choice_and_quality(trained):
    best, _, metrics = trained
    r2 = {r["model"]: r["value"] for r in metrics.filter("metric = 'R2'").collect()}
    assert best == max(r2, key=r2.get)
    assert r2["tree"] > 0


def test_importances_are_named(parts, trained):
    _, fitted, _ = trained
    transformed = fitted["tree"].transform(parts[0])
    names = features.slot_names(transformed)
    assert len(names) == fitted["tree"].stages[-1].numFeatures
    assert "area_m2_filled" in names and "area_m2_unknown" in names
    table = models.feature_importance(fitted["tree"], transformed).collect()
    assert len(table) <= 20 and table[0]["importance"] >= table[-1]["importance"]
    with pytest.raises(ValueError):
        models.feature_importance(fitted["linear"], transformed)


def test_saved_model_predicts_the_same(spark, parts, trained, tmp_path):
    _, fitted, _ = trained
    models.save_model(fitted["tree"], str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    one = scoring.score_batch(parts[1], fitted["tree"], features.LOG_FULL, ["listing_id"])
    two = scoring.score_batch(parts[1], again, features.LOG_FULL, ["listing_id"])
    assert one.exceptAll(two).count() == 0 and one.count() == parts[1].count()


def test_scoring_of_bare_subjects(spark, trained):
    from parcelframe.sources import listings

    subject = {"city_province": "ASIA", "district": "new", "category": "HOUSEHOLD", "direction": "Đông", "liability": "F",
               "area_m2": 80.0, "floor_num": None, "toilet_num": 1, "livingroom_num": 1, "bedroom_num": 2, "street_width_m": 5.0}
    scored = scoring.score_batch(listings.rows_to_frame(spark, subject), trained[1]["tree"], features.LOG_FULL)
    row = scoring.with_total_price(scored).first()
    assert row["predicted_price_per_m2"] > 0
    assert row["total_price"] == pytest.approx(row["predicted_price_per_m2"] * 80, rel=1e-6)
    assert row["total_price_text"].endswith("VND")


def test_unknown_numbers_are_filled_by_the_model(spark, data):
    clean = views.clean(spark, data).withColumn("price_log", F.log1p(F.col("price_per_m2").cast("double"))).cache()
    fitted = models.train_models(clean, features.LOG_FULL, {"tree": {"maxDepth": 4}})["tree"]
    whole = scoring.score_batch(clean, fitted, features.LOG_FULL, ["listing_id"])
    assert whole.count() == clean.count() and whole.filter("predicted_price_per_m2 is null").count() == 0
    for other in (None, float("nan")):
        changed = clean.withColumn("floor_num", F.when(F.col("floor_num") != -1, F.col("floor_num").cast("double")).otherwise(other))
        assert scoring.score_batch(changed, fitted, features.LOG_FULL, ["listing_id"]).exceptAll(whole).count() == 0
    medians = features.fit_features(clean, features.LOG_FULL).stages[0].getStatement()
    known = sorted(r[0] for r in clean.filter("floor_num <> -1").select(F.col("floor_num").cast("double")).collect())
    middle = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    assert f"THEN {middle!r}D ELSE CAST(`floor_num`" in medians
    absent = scoring.score_batch(clean.drop("floor_num", "liability"), fitted, features.LOG_FULL, ["listing_id"])
    assert absent.count() == clean.count()
    clean.unpersist()


def test_approximate_medians_give_the_same_frame_shape(spark, data):
    clean = views.clean(spark, data)
    near = cleaning.prepare_model_frame(clean, exact=False)
    assert near.columns == cleaning.prepare_model_frame(clean).columns
    assert near.filter("floor_num = -1").count() == 0


def test_stream_equals_batch(spark, data, trained, tmp_path):
    raw = views.raw(spark, data)
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = ingest.stream_files(spark, str(tmp_path / "in"), raw.schema, files_per_batch=1)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):  # a second run finds nothing new
        ingest.append_available(ingest.stream_clean(stream), out, progress).awaitTermination()
    batch = cleaning.clean_listings_a(raw)
    stored = spark.read.parquet(out).select(*batch.columns)
    assert stored.count() == batch.count()
    assert stored.exceptAll(batch).count() == 0


def test_stream_scores_equal_batch_scores(spark, data, trained, tmp_path):
    from parcelframe.operators import columns as cols

    clean = cols.missing_flags(views.clean(spark, data))
    clean.write.parquet(str(tmp_path / "in"))
    stream = ingest.stream_files(spark, str(tmp_path / "in"), clean.schema)
    model = trained[1]["tree"]
    scored = ingest.stream_score(stream, model, features.LOG_FULL, ["listing_id"])
    out = str(tmp_path / "out")
    ingest.append_available(scored, out, str(tmp_path / "progress")).awaitTermination()
    batch = scoring.score_batch(clean, model, features.LOG_FULL, ["listing_id"])
    assert spark.read.parquet(out).exceptAll(batch).count() == 0


def test_monthly_means_from_daily_totals(spark, data, tmp_path):
    clean = views.clean(spark, data)
    days = clean.groupBy(F.to_date("posting_ts").alias("day")).agg(
        F.count("price_per_m2").alias("priced"), F.sum(F.col("price_per_m2").cast("double")).alias("amount")
    )
    direct = clean.groupBy(F.month("posting_ts").alias("posting_month")).agg(F.avg(F.col("price_per_m2").cast("double")).alias("avg_price"))
    assert ingest.month_means_of_days(days).exceptAll(direct).count() == 0


def test_few_partitions_are_spread_over_all_cores(spark, parts, monkeypatch):
    cores, seen = spark.sparkContext.defaultParallelism, []
    made = models.regressor

    class Watched:
        def __init__(self, *chosen):
            self.own = made(*chosen)

        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return self.own.fit(df)

    monkeypatch.setattr(models, "regressor", Watched)
    few = parts[0].coalesce(1)
    models.train_one(few, features.LOG_FULL, "tree", SMALL["tree"])
    models.train_one(few.repartition(cores + 3), features.LOG_FULL, "tree", SMALL["tree"])
    assert seen == [(cores, few.count()), (cores + 3, few.count())]

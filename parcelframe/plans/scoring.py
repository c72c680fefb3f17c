"""Applying price models to tables of subjects."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelframe import fixed
from parcelframe.functions import numbers
from parcelframe.operators import columns as cols
from parcelframe.operators.comparables import fallback_estimate
from parcelframe.operators.quantiles import exact_quantiles, quantile_values
from parcelframe.plans.features import FeaturePreset
from parcelframe.session import stored


def score_batch(subjects: DataFrame, model: PipelineModel, preset: FeaturePreset, keep=()) -> DataFrame:
    """Predicted price per square metre for a batch or a stream of subjects, one row for each subject.

    The model fills unknown numbers (null, NaN or -1, and columns that the subjects lack) as it did in training.
    """
    ready = cols.add_placeholders(subjects, {c: fixed.MISSING_NUMBER for c in preset.numeric})
    ready = cols.add_placeholders(ready, {c: F.lit(None).cast("string") for c in preset.categorical})
    scored = model.transform(ready)
    price = F.col("prediction")
    if preset.log_label:
        price = numbers.unlog_price(price)
    kept = keep or subjects.columns
    return scored.select(*kept, price.alias("predicted_price_per_m2"))


def with_total_price(scored: DataFrame, unit_price: str = "predicted_price_per_m2", area: str = "area_m2") -> DataFrame:
    """Adds the total price in VND, in billions, and as text."""
    total = numbers.total_price(F.col(unit_price), F.col(area).cast("double"))
    return scored.withColumn("total_price", total).withColumns(
        {
            "total_price_billion": numbers.in_billions(F.col("total_price")),
            "total_price_text": numbers.format_price(F.col("total_price")),
        }
    )


def score_with_fallback(
    predicted: DataFrame,
    subjects: DataFrame,
    listings: DataFrame,
    subject_key: str,
    prediction: str = "predicted_price_per_m2",
) -> DataFrame:
    """Final price per subject: the prediction, else the tiered estimate, else the default.

    ``predicted`` may lack subjects or predictions.
    """
    estimate = fallback_estimate(subjects, listings, subject_key)
    final = F.coalesce(F.col(prediction), F.col("estimate"), F.lit(fixed.DEFAULT_PRICE_PER_M2))
    source = (
        F.when(F.col(prediction).isNotNull(), "model").when(F.col("estimate").isNotNull(), "fallback").otherwise("default")
    )
    return estimate.join(predicted.select(subject_key, prediction), subject_key, "left").select(
        subject_key, final.alias("price_per_m2"), source.alias("source")
    )


def prediction_interval(
    predictions: DataFrame, holdout: DataFrame, actual: str, prediction: str = "prediction", level: float = 0.9
) -> DataFrame:
    """Adds ``lower`` and ``upper``: the prediction plus and minus the holdout's residual quantile."""
    residual: Column = F.abs(F.col(actual).cast("double") - F.col(prediction))
    found = quantile_values(holdout.select(residual.alias("residual")), "residual", {"reach": level})
    reach = F.lit(found["reach"])
    return predictions.withColumns({"lower": F.col(prediction) - reach, "upper": F.col(prediction) + reach})


def conformal_interval(
    predictions: DataFrame,
    holdout: DataFrame,
    actual: str,
    prediction: str = "prediction",
    level: float = 0.9,
    key: str | None = None,
    least: int = 1,
) -> DataFrame:
    """Adds ``lower``, ``upper`` and ``calibrated``: intervals that hold a new price with probability ``level`` or more.

    The reach is the holdout's absolute residual of rank ceil((n + 1) x level), which makes the promise hold for every n if the
    holdout took no part in training. With a key each group has its own reach; groups with fewer than ``least`` holdout rows or too few
    for that rank, and rows without a key, take the pooled one (``calibrated`` is ``group`` or ``pooled``). Where even the pooled
    holdout is too small the interval is unbounded. Holdout rows whose residual is null or NaN are left out.
    """
    rank = f"ceil(cast('{level!r}' as decimal(10,9)) * (_total + 1)) - 1"
    residual: Column = F.nanvl(F.abs(F.col(actual).cast("double") - F.col(prediction).cast("double")), F.lit(None))
    columns = [residual.alias("_residual")] if key is None else [F.col(key), residual.alias("_residual")]
    residuals = holdout.select(*columns)
    pooled = exact_quantiles(residuals, "_residual", {"reach": rank}).first()["reach"]
    reach = F.lit(float("inf") if pooled is None else pooled)
    if key is None:
        spanned = predictions.withColumns({"_reach": reach, "calibrated": F.lit("pooled")})
    else:
        own = exact_quantiles(residuals, "_residual", {"_own": f"if(_total >= {int(least)}, {rank}, _total)"}, [key])
        # One row per group; its size decides how it is joined.
        spanned = predictions.join(stored(own.filter("_own is not null"), "reaches"), key, "left").withColumns(
            {"_reach": F.coalesce("_own", reach), "calibrated": F.when(F.col("_own").isNull(), "pooled").otherwise("group")}
        )
    ends = {"lower": F.col(prediction) - F.col("_reach"), "upper": F.col(prediction) + F.col("_reach")}
    return spanned.withColumns(ends).select(*predictions.columns, "lower", "upper", "calibrated")

"""Feature stages for price models and the stable names of their vector slots."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe import fixed
from parcelframe.operators.quantiles import exact_medians


@dataclass(frozen=True)
class FeaturePreset:
    """How features and label are made. ``log_label`` tells scoring to undo the logarithm.

    Every preset keeps every row: a number that is null, NaN or -1 is unknown. With ``imputed`` it becomes the
    column's median, found when the features are fitted and held by the model; otherwise it is -1, as in the
    cleaned tables. With ``flags`` the model itself marks unknown numbers.
    """

    label: str
    log_label: bool
    flags: bool
    centered: bool
    imputed: bool
    categorical: Sequence[str] = fixed.CATEGORICAL_FEATURES
    numeric: Sequence[str] = fixed.NUMERIC_FEATURES

    @property
    def inputs(self) -> list[str]:
        return [*self.categorical, *self.numeric]

    @property
    def filled_columns(self) -> list[str]:
        return [f"{c}_filled" for c in self.numeric]

    @property
    def flag_columns(self) -> list[str]:
        return [f"{c}_unknown" for c in self.numeric] if self.flags else []


LOG_FULL = FeaturePreset(label="price_log", log_label=True, flags=True, centered=True, imputed=True)
RAW_QUICK = FeaturePreset(label="price_per_m2", log_label=False, flags=False, centered=False, imputed=False)


def fill_stage(medians: dict[str, float | None], preset: FeaturePreset) -> SQLTransformer:
    """Adds ``<c>_filled`` and, if asked for, ``<c>_unknown`` of every numeric column; the values are part of the stage."""
    added = []
    for c in preset.numeric:
        unknown = f"coalesce(isnan(CAST(`{c}` AS DOUBLE)) OR CAST(`{c}` AS DOUBLE) = {float(fixed.MISSING_NUMBER)!r}D, true)"
        # A column without any known value has no median; then all its rows are alike.
        median = medians.get(c) if preset.imputed else fixed.MISSING_NUMBER
        filled = 0.0 if median is None else float(median)
        added.append(f"CASE WHEN {unknown} THEN {filled!r}D ELSE CAST(`{c}` AS DOUBLE) END AS `{c}_filled`")
        if preset.flags:
            added.append(f"CAST({unknown} AS INT) AS `{c}_unknown`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(added)} FROM __THIS__")


def string_indexer(categorical: Sequence[str]) -> StringIndexer:
    """Index by falling frequency, all columns in one pass; null and unseen texts get one extra index."""
    return StringIndexer(
        inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep"
    )


def one_hot_encoder(categorical: Sequence[str]) -> OneHotEncoder:
    """Sparse indicator vectors; the extra index is all zeros."""
    return OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_vec" for c in categorical])


def assembler(preset: FeaturePreset) -> VectorAssembler:
    """All slots as one vector. Nothing can be missing here, so a null is an error and never drops a row."""
    inputs = [f"{c}_vec" for c in preset.categorical] + preset.filled_columns + preset.flag_columns
    return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")


def scaler(preset: FeaturePreset) -> StandardScaler:
    """Unit deviation. Centring makes the vectors dense, which costs memory with many categories."""
    return StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=preset.centered)


def feature_stages(preset: FeaturePreset, medians: dict[str, float | None]) -> list:
    return [
        fill_stage(medians, preset), string_indexer(preset.categorical), one_hot_encoder(preset.categorical), assembler(preset), scaler(preset)
    ]


def fit_features(train: DataFrame, preset: FeaturePreset, fit_on: DataFrame | None = None) -> PipelineModel:
    """The fitted feature stages, medians included. ``fit_on`` takes the medians from another table than ``train``."""
    medians = exact_medians(train if fit_on is None else fit_on, preset.numeric) if preset.imputed else {}
    return Pipeline(stages=feature_stages(preset, medians)).fit(train)


def slot_names(transformed: DataFrame, column: str = "features") -> list[str]:
    """Name of every slot of the assembled vector, from the column's own metadata."""
    groups = transformed.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((slot for group in groups for slot in group), key=lambda slot: slot["idx"])
    return [slot["name"] for slot in slots]


def standardized(df: DataFrame, columns: Sequence[str] = fixed.NUMERIC_FEATURES, centered: bool = True) -> DataFrame:
    """Plain-column form of the scaler: ``<c>_scaled`` has unit sample deviation."""
    x = {c: F.col(c).cast("double") for c in columns}
    aggregates = [F.avg(x[c]).alias(f"{c}_mean") for c in columns] + [F.stddev_samp(x[c]).alias(f"{c}_std") for c in columns]
    moments = df.agg(*aggregates).first().asDict()
    scaled = {}
    for c in columns:
        mean, deviation = (moments[f"{c}_mean"] if centered else 0.0), moments[f"{c}_std"]
        scaled[f"{c}_scaled"] = (x[c] - F.lit(mean)) / deviation if deviation else F.lit(0.0)
    return df.withColumns(scaled)

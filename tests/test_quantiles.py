"""Exact quantiles against numpy, on skewed groups and awkward values."""

import numpy as np
import pandas as pd
import pytest

from parcelframe.operators import quantiles

PROBS = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99}


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 6000
    values = np.concatenate([rng.lognormal(16, 1, n // 2), -rng.lognormal(2, 3, n // 3), np.zeros(n // 6)])
    pdf = pd.DataFrame({"g": rng.choice(["hot", "b", "c"], n, p=[0.9, 0.09, 0.01]), "d": values})
    pdf["f"] = pdf["d"].astype("float32")
    pdf["i"] = rng.integers(-1, 6, n)
    df = spark.createDataFrame(pdf).repartition(4).cache()
    yield pdf, df
    df.unpersist()


@pytest.mark.parametrize("column", ["d", "f", "i"])
def test_whole_table(frame, column):
    pdf, df = frame
    found = quantiles.quantile_values(df, column, PROBS)
    for name, p in PROBS.items():
        assert found[name] == pytest.approx(pdf[column].astype(float).quantile(p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("column", ["d", "f"])
def test_per_group(frame, column):
    pdf, df = frame
    rows = quantiles.exact_quantiles(df, column, PROBS, ["g"]).collect()
    assert len(rows) == 3
    for row in rows:
        group = pdf[pdf["g"] == row["g"]][column].astype(float)
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(group.quantile(p), rel=1e-12, abs=1e-12)


def test_nothing_to_count(frame):
    _, df = frame
    assert quantiles.quantile_values(df.filter("g = 'none'"), "f", {"p": 0.5}) == {"p": None}


def test_medians_leave_the_sentinel_out(frame):
    pdf, df = frame
    known = pdf[pdf["i"] != -1]["i"]
    assert quantiles.exact_medians(df, ["i"]) == {"i": known.median()}
    near = quantiles.approx_medians(df, ["i"])["i"]
    rank = (known <= near).mean(), (known < near).mean()
    assert rank[1] - 0.01 <= 0.5 <= rank[0] + 0.01


def test_infinite_and_missing_values(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, float("inf"), float("nan"), None, float("-inf"), 3.0)], "x float")
    assert quantiles.quantile_values(df, "x", {"low": 0.0, "mid": 0.5, "next": 0.25}) == {"low": float("-inf"), "mid": 2.0, "next": 1.0}


def test_medians_keep_doubles(spark):
    rows = spark.createDataFrame([(0.1, 1.0), (55.1, -1.0), (55.3, float("nan"))], "a double, b float")
    assert quantiles.exact_medians(rows, ["a", "b"]) == {"a": 55.1, "b": 1.0}

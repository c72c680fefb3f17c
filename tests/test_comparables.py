"""Comparables and tiered estimates against brute force, with one place that holds most rows."""

import numpy as np
import pandas as pd
import pytest

from parcelframe.operators import comparables


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    n = 400
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "city_province": rng.choice(["A", "B", "C"], n, p=[0.8, 0.15, 0.05]),
            "district": rng.choice(["x", "y", None], n, p=[0.8, 0.15, 0.05]),
            "category": rng.choice(["house", "flat"], n, p=[0.9, 0.1]),
            # Few areas, so that ties and band ends on listed areas occur: 70 = 0.7 * 100, 130 = 1.3 * 100.
            "area_m2": rng.choice([30.0, 52.5, 70.0, 70.5, 91.0, 100.0, 130.0, 500.0], n),
            "price_per_m2": rng.integers(16, 800, n) * 125_000.125,
            "bedroom_num": rng.integers(1, 4, n),
            "floor_num": rng.integers(1, 4, n),
        }
    )
    subjects = pd.DataFrame(
        {
            "sid": np.arange(8),
            "city_province": ["A", "A", "B", "C", "Z", None, "A", "A"],
            "district": ["x", "x", "y", "x", "x", "x", None, "x"],
            "category": ["house", "flat", "house", "flat", "house", "house", "house", "none"],
            "area_m2": [100.0, 100.0, 70.5, 500.0, 100.0, 100.0, 100.0, 9999.0],
        }
    )
    schema = "id long, city_province string, district string, category string, area_m2 double, price_per_m2 double, bedroom_num long, floor_num long"
    listed = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), schema)
    asked = spark.createDataFrame(
        subjects.astype(object).where(subjects.notna(), None).values.tolist(),
        "sid long, city_province string, district string, category string, area_m2 double",
    )
    return pdf, subjects, listed, asked


def _similar(pdf, s, category=False):
    if s.city_province is None or s.district is None:
        return pdf.iloc[:0]
    mask = (pdf.city_province == s.city_province) & (pdf.district == s.district)
    mask &= (pdf.area_m2 > s.area_m2 * 0.7) & (pdf.area_m2 < s.area_m2 * 1.3)
    return pdf[mask & (pdf.category == s.category)] if category else pdf[mask]


def test_summary(tables):
    pdf, subjects, listed, asked = tables
    rows = {r["sid"]: r for r in comparables.comparables_summary(asked, listed, "sid").collect()}
    assert len(rows) == len(subjects)
    for s in subjects.itertuples():
        near = _similar(pdf, s)
        assert rows[s.sid]["n_similar"] == len(near)
        expected = near.price_per_m2.mean() if len(near) else None
        assert rows[s.sid]["avg_similar"] == (pytest.approx(expected, rel=1e-12) if len(near) else None)


def test_top(tables):
    pdf, subjects, listed, asked = tables
    rows = comparables.comparables_top(asked, listed, "sid", "id").collect()
    found = {}
    for r in rows:
        found.setdefault(r["sid"], []).append((r["rank"], r["listing_key"], r["price_per_m2"]))
    for s in subjects.itertuples():
        near = _similar(pdf, s)
        near = near.assign(far=(near.area_m2 - s.area_m2).abs()).sort_values(["far", "id"]).head(5)
        expected = [(i + 1, r.id, r.price_per_m2) for i, r in enumerate(near.itertuples())]
        assert sorted(found.get(s.sid, [])) == expected


def test_fallback(tables):
    pdf, subjects, listed, asked = tables
    rows = {r["sid"]: r for r in comparables.fallback_estimate(asked, listed, "sid").collect()}
    assert {r["tier"] for r in rows.values()} >= {1, 2, 3, 4}
    for s in subjects.itertuples():
        tiers = [
            (_similar(pdf, s, category=True), 3),
            (pdf[(pdf.city_province == s.city_province) & (pdf.district == s.district)] if s.district else pdf.iloc[:0], 3),
            (pdf[pdf.city_province == s.city_province], 1),
            (pdf, 1),
        ]
        tier, chosen = next((i + 1, t) for i, (t, least) in enumerate(tiers) if len(t) >= least)
        assert rows[s.sid]["tier"] == tier
        assert rows[s.sid]["estimate"] == pytest.approx(chosen.price_per_m2.mean(), rel=1e-12)


def test_fallback_of_an_empty_market(tables):
    _, _, listed, asked = tables
    rows = comparables.fallback_estimate(asked, listed.filter("id < 0"), "sid").collect()
    assert {(r["tier"], r["estimate"]) for r in rows} == {(5, 30_000_000.0)}


def test_prices_of_any_size_keep_their_digits(spark):
    listed = spark.createDataFrame(
        [(k, "A", "x", "c", 100.0 + k / 100, p, 1, 1) for k, p in enumerate([0.0004, 0.0004, 0.0004, 0.0005])]
        + [(10, "A", "y", "c", 100.0, 2e15, 1, 1), (11, "A", "y", "c", 135.0, 1e-4, 1, 1), (12, "A", "y", "c", float("nan"), 5.0, 1, 1)],
        "id long, city_province string, district string, category string, area_m2 double, price_per_m2 double, bedroom_num long, floor_num long",
    )
    asked = spark.createDataFrame(
        [(1, "A", "x", "c", 100.0), (2, "A", "y", "c", 110.0), (3, "A", "y", "c", 150.0), (4, "A", "y", "c", float("nan"))],
        "sid long, city_province string, district string, category string, area_m2 double",
    )
    got = {r["sid"]: (r["n_similar"], r["avg_similar"]) for r in comparables.comparables_summary(asked, listed, "sid").collect()}
    assert got[1] == (4, pytest.approx(0.000425, rel=1e-12))
    assert got[2] == (2, pytest.approx(1e15, rel=1e-12))
    assert got[3] == (1, pytest.approx(1e-4, rel=1e-12))
    assert got[4] == (0, None)

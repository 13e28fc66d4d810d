"""Ridge folds from sums against fits of each fold's rows by numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from snaplake.operators import ridge
from snaplake.plans import models


def by_rows(rows, numbers, category, target, alpha):
    """(fold, n_train, n_valid, rmse, weights, intercept) by fitting each fold's rows."""
    days, out = sorted(rows["day"].dropna().unique()), []
    rows = rows[rows["day"].notna() & rows[target].notna()]
    for fold in range(1, 5):
        first = len(days) - (4 - fold + 1) * 2
        train, valid = rows[rows["day"] < days[first]], rows[(rows["day"] >= days[first]) & (rows["day"] <= days[first + 1])]
        fill = train[numbers].mean()
        kinds = sorted(train[category].fillna("").unique())
        dense = lambda x: np.c_[x[numbers].fillna(fill).to_numpy(float), np.array([[c == k for k in kinds] for c in x[category].fillna("")], dtype=float).reshape(len(x), len(kinds))]  # noqa: E731, B023
        x, y = dense(train), train[target].to_numpy(float)
        mean, scale = x.mean(axis=0), np.ones(x.shape[1])
        scale[: len(numbers)] = x[:, : len(numbers)].std(axis=0)
        z = (x - mean) / scale
        w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean())) / scale
        error = dense(valid) @ w + (y.mean() - w @ mean) - valid[target]
        out.append((fold, len(train), len(valid), float(np.sqrt((error**2).mean())), w[: len(numbers)]))
    return out


def same(got, want):
    assert [(g["fold"], g["n_train"], g["n_valid"]) for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert g["rmse"] == pytest.approx(w[3], rel=1e-6) and list(g["fit"].weights.values()) == pytest.approx(list(w[4]), rel=1e-5, abs=1e-7)


def test_given_rows(spark):
    df = models.features_of(spark, "/root/testdata/sf0.001")
    want = by_rows(df.toPandas(), models.NUMBERS, "brand", "points", 1.0)
    got = ridge.ridge_folds(df, F.col("day"), models.NUMBERS, "brand", "points")
    same(got, want)
    # The prediction as a column has the error that the sums tell of.
    last, days = got[-1]["fit"], sorted(r[0] for r in df.select("day").distinct().collect() if r[0])
    error = df.where(F.col("day").isin(days[-2:])).agg(F.sqrt(F.avg(F.pow(last.predict("brand") - F.col("points"), 2)))).first()[0]
    assert error == pytest.approx(got[-1]["rmse"], rel=1e-6)


def test_missing_numbers_new_categories_and_odd_rows(spark):
    r = np.random.default_rng(3)
    n = 900
    rows = pd.DataFrame({"day": r.integers(0, 14, n), "a": r.normal(5, 2, n), "b": r.normal(0, 100, n), "k": r.choice(["x", "y", "z"], n), "y": 0.0})
    rows["y"] = 3 * rows["a"] - 0.1 * rows["b"] + rows["k"].map({"x": 1, "y": 5, "z": -2}) + r.normal(0, 1, n)
    rows.loc[r.random(n) < 0.2, "a"] = np.nan
    rows.loc[rows["day"] >= 12, "k"] = "new"
    data = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in t) for t in rows.itertuples(index=False)]
    data += [(None, 1.0, 1.0, "x", 9.0), (3, 1.0, None, None, None)]
    df = spark.createDataFrame([(None if d is None else int(d), a, b, k, y) for d, a, b, k, y in data], "day int, a double, b double, k string, y double")
    same(ridge.ridge_folds(df, F.col("day"), ["a", "b"], "k", "y", alpha=2.0), by_rows(rows, ["a", "b"], "k", "y", 2.0))


def test_few_days_and_no_rows(spark):
    df = spark.createDataFrame([(d, float(d), "x", float(d)) for d in range(6)], "day int, a double, k string, y double")
    got = ridge.ridge_folds(df, F.col("day"), ["a"], "k", "y", alpha=0.0001)
    assert [g["fold"] for g in got] == [4] and got[0]["rmse"] < 0.01
    assert ridge.ridge_folds(df.limit(0), F.col("day"), ["a"], "k", "y") == []

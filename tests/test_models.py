import datetime as dt
import random

import pytest
from pyspark.ml import Estimator
from pyspark.sql import functions as F
from snaplake.plans import models


@pytest.fixture(scope="module")
def different(spark):
    """Rows of few numbers, some missing, and labels that never repeat."""
    r, days = random.Random(5), [dt.date(2020 + i // 4, 1 + 3 * (i % 4), 1) for i in range(8)]
    rows = []
    for key in range(4000):
        q, s, p, b = float(r.randint(1, 5)), r.choice([None, 1.0, 2.0, 4.0]), float(r.randint(1, 3)), r.choice("abcd")
        rows.append((key, r.choice(days), q * 3 + (s or 7.0) * p + (b == "c") * 5 + r.gauss(0, 2), q, s, p, b))
    return spark.createDataFrame(rows, "key long, day date, points double, quantity double, size double, price double, brand string").cache()


def by_rows(rows, families, n_splits=2):
    """walk_forward with pyspark.ml fitted on the rows themselves."""
    out, e, days = [], F.col("prediction") - F.col("points"), sorted(r.day for r in rows.select("day").distinct().collect())
    for fold in range(1, n_splits + 1):
        at = len(days) - 2 * (n_splits - fold + 1)
        one = models.weighted(rows)
        train, valid = one.where(F.col("day") < days[at]), one.where(F.col("day").between(days[at], days[at + 1]))
        prepared = models.prepared_by(train)
        for family in families:
            scored = models.regressor(family, "points").fit(prepared.transform(train)).transform(prepared.transform(valid))
            out.append((family, fold, *scored.agg(F.sqrt(F.avg(e * e)), F.avg(F.abs(e))).first()))
    return out


def test_models_of_rows_that_never_repeat_fit_on_cells(different, monkeypatch):
    seen, fit = [], Estimator.fit

    def counted(self, dataset, params=None):
        seen.append((type(self).__name__, dataset.count()))
        return fit(self, dataset, params)

    with monkeypatch.context() as m:
        m.setattr(Estimator, "fit", counted)
        got = [tuple(r) for r in models.walk_forward(different).collect()]
    # Combinations of numbers and brands; the rows are 4,000.
    assert {n for n, _ in seen} >= {"LinearRegression", "RandomForestRegressor", "GBTRegressor"} and max(n for _, n in seen) <= 5 * 4 * 3 * 4
    want = by_rows(different, models.FAMILIES)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):  # forests draw other bootstraps
        assert g[2:] == pytest.approx(w[2:], rel=0.1 if g[0] == "forest" else 1e-6)


def test_bootstraps_take_rows_as_often_as_poisson_does(spark):
    rows = spark.range(20_000).select(*[models.drawn(F.xxhash64("id"), t).alias(f"t{t}") for t in range(3)])
    r = rows.agg(*[f(c) for c in rows.columns for f in (F.avg, F.var_pop)], F.corr("t0", "t1"), F.max("t0")).first()
    assert r[:6] == pytest.approx((1.0,) * 6, abs=0.05) and abs(r[6]) < 0.03 and r[7] >= 5
    assert rows.groupBy("t0").count().where("t0 = 0").first()["count"] == pytest.approx(20_000 * 0.367879, rel=0.03)


def test_bins_are_of_filled_numbers(spark):
    rows = spark.range(1, 10_001).select(F.col("id").cast("double").alias("quantity"), F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("size"), F.lit(3.0).alias("price"))
    medians, edges = models.quantiles_of(rows)
    filled = models.preprocessing(models.NUMBERS, models.KINDS)[0].fit(rows).transform(rows)
    want = filled.approxQuantile(["quantity_filled", "size_filled"], [i / 32 for i in range(1, 32)], 0.0001)
    assert medians == pytest.approx([5000, 5000, 3], rel=0.002)
    for e, w in zip(edges, want):
        assert all(min(abs(x - y) for y in b) < 25 for a, b in ((e, w), (w, e)) for x in a)
    assert len(edges[0]) == 31 and edges[2] == [3.0]


def test_odd_rows_of_models(spark, different):
    odd = different.withColumns({"price": F.lit(1.0), "size": F.when(F.col("key") % 3 == 0, float("nan")).otherwise(F.col("size")), "brand": F.when(F.col("key") % 5 > 0, F.col("brand")), "points": F.when(F.col("key") % 11 > 0, F.col("points"))})
    got = models.amount_models(odd, "points")
    known = odd.where("points IS NOT NULL")
    for family, m in got.items():
        e = F.col("prediction") - F.col("points")
        want = m.transform(known).agg(F.sqrt(F.avg(e * e)), F.count("prediction")).first()
        assert want[1] == known.count() and models.rmse_of(odd, "points", family, m) == pytest.approx(want[0], rel=1e-9)
    with pytest.raises(ValueError, match="size"):
        models.amount_models(different.withColumn("size", F.lit(None).cast("double")), "points")

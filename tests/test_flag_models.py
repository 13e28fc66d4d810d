"""Models of flags and targets from sums and cells against pyspark.ml fitted on the rows themselves."""

import datetime as dt
import math
import random

import pytest
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from snaplake.plans import catalog, models

#: Combinations of numbers and brands in `different`, and rows of a cell with either flag.
CELLS, FLAGS = 6 * 4 * 3 * 4, 2


@pytest.fixture(scope="module")
def different(spark):
    """Rows of few numbers, some missing, with points that never repeat and flags that depend on the numbers."""
    r, days = random.Random(9), [dt.date(2020 + i // 4, 1 + 3 * (i % 4), 1) for i in range(12)]
    rows = []
    for key in range(4000):
        q, s, p, b = float(r.choice([1, 5, 10, 20, 30, 40])), r.choice([None, 1.0, 2.0, 4.0]), float(r.randint(1, 3)), r.choice(["a", "b", "c", None])
        started = float(r.random() < 1 / (1 + math.exp(2.5 - q / 20 - p + (b == "c"))))
        rows.append((key, r.choice(days), q * 3 + (s or 7.0) * p + (b == "c") * 5 + r.gauss(0, 2), started, q, s, p, b))
    return spark.createDataFrame(rows, "key long, day date, points double, started double, quantity double, size double, price double, brand string").cache()


def by_rows(train, valid, label, family):
    """The Brier score on valid of pyspark.ml's classifier of the rows of train."""
    one = train.where(F.col(label).isNotNull()).withColumn(models.WEIGHT, F.lit(1.0))
    prepared = models.prepared_by(one)
    made = {
        "linear": LogisticRegression(labelCol=label, regParam=0.01, tol=1e-13, maxIter=500), "forest": RandomForestClassifier(labelCol=label, numTrees=10, maxDepth=4, seed=7),
        "boosted": GBTClassifier(labelCol=label, maxIter=5, maxDepth=3, seed=7),
    }[family]
    scored = made.fit(prepared.transform(one)).transform(prepared.transform(valid.where(F.col(label).isNotNull())))
    return scored.agg(F.avg(F.pow(vector_to_array("probability")[1] - F.col(label), 2))).first()[0]


def fitted_rows(monkeypatch):
    """A list that gets the class and the number of rows of every fit."""
    seen, fit = [], Estimator.fit

    def counted(self, dataset, params=None):
        seen.append((type(self).__name__, dataset.count()))
        return fit(self, dataset, params)

    monkeypatch.setattr(Estimator, "fit", counted)
    return seen


def test_flags_of_rows_are_those_of_sums_and_cells(different):
    days = sorted(r.day for r in different.select("day").distinct().collect())
    rows = different.withColumn("started", F.when(F.col("key") % 7 > 0, F.col("started")))
    got = models.chosen_families(rows, ["started"])["started"]["scores"]
    for family in models.FAMILIES:
        want = [by_rows(rows.where(F.col("day") < days[at]), rows.where(F.col("day").between(days[at], days[at + 1])), "started", family) for at in (8, 10)]
        assert got[family] == pytest.approx(sum(want) / 2, rel=0.04 if family == "forest" else 1e-6)  # forests draw other bootstraps


def test_logistic_models_of_several_flags_and_weights(spark, different):
    rows = models.with_targets(different)
    once = rows.withColumn(models.WEIGHT, 1.0 + F.col("key") % 3)
    with models.Summary(once) as s:
        got = {y: m["linear"] for y, m in s.flags({"started": ("linear",), "subbed": ("linear",)}).items()}
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), (1 + F.col("key") % 3).cast("int"))))
    new = spark.createDataFrame([(9.0, 1.0, 2.0, "new"), (9.0, 1.0, 2.0, None)], "quantity double, size double, price double, brand string")
    for y, m in got.items():
        prepared = models.prepared_by(many.withColumn(models.WEIGHT, F.lit(1.0)))
        want = LogisticRegression(labelCol=y, regParam=0.01, tol=1e-13, maxIter=500).fit(prepared.transform(many)).transform(prepared.transform(rows)).agg(F.avg(F.pow(vector_to_array("probability")[1], 2))).first()[0]
        assert m.transform(rows).agg(F.avg(F.pow("prediction", 2))).first()[0] == pytest.approx(want, rel=1e-5)
        a, b = [r.prediction for r in m.transform(new).collect()]
        assert a == b and 0 < a < 1


def test_logistic_model_of_constant_numbers_and_one_category(different):
    rows = different.withColumns({"quantity": F.lit(2.0), "size": F.lit(3.0), "price": F.lit(4.0), "brand": F.lit("a")})
    got = models.best_classifier(rows, "started", families=("linear",))
    mean = different.agg(F.avg("started")).first()[0]
    assert {round(r.p, 9) for r in models.with_chance(got, rows, "p").select("p").distinct().collect()} == {round(mean, 9)}


@pytest.mark.parametrize("name", ["l3_start_classifier", "l4_hierarchical_targets", "l5_hierarchical_folds", "l7_live_scoring"])
def test_queries_fit_on_cells_however_many_rows(spark, different, monkeypatch, name):
    with monkeypatch.context() as m:
        m.setattr(models, "features_of", lambda *_: different)
        seen = fitted_rows(m)
        got = catalog.QUERIES[name](spark, "").collect()
    assert got and seen and max(n for _, n in seen) <= FLAGS * CELLS < different.count() / 4


def test_amounts_take_the_family_with_the_lowest_error_on_rows(different):
    rows = models.with_targets(different)
    with models.Summary(rows, models.AMOUNTS) as s:
        for t in models.AMOUNTS:
            for family in ("linear", "boosted"):
                model, e = s.amount(family, t), F.col("prediction") - F.col(t)
                assert s.rmse(family, t, model) == pytest.approx(model.transform(rows).agg(F.sqrt(F.avg(e * e))).first()[0], rel=1e-6, abs=1e-6)


def test_bins_end_between_values(spark):
    """Half of the rows are at 25 or below, so a bin ends there: trees tell 25 from 26."""
    rows = spark.range(5000).select(*[(F.col("id") % 50 + 1).cast("double").alias(c) for c in models.NUMBERS])
    assert 26.0 in models.quantiles_of(rows)[1][0]


def test_held_out_days(different):
    from snaplake.operators.sequence import time_holdout

    rows = different.withColumn("day", F.when(F.col("key") % 9 > 0, F.col("day")))
    want = {p: sorted(r.key for r in time_holdout(rows, F.col("day"), 365).where(F.col("part") == p).collect()) for p in ("train", "valid")}
    got = dict(zip(("train", "valid"), (sorted(r.key for r in part.collect()) for part in models.held_out(rows, 365))))
    assert got == want and all(want.values())

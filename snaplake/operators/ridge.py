"""Ridge regression on rolling folds from sums by day: one pass fits and scores every fold.

What least squares needs of its rows are sums of products, and sums add up. One grouping by
(day, category) makes them; the rows of a fold are a range of days, so its sums are a difference
of running sums, and nothing is read again for another fold or another penalty. The error of
a fold's window follows from the window's sums as well.

Numbers are scaled to unit variance and centred per fold; missing ones take the mean of the fold's
training rows, which is a linear change of (number or 0, is missing), so sums of those two are
enough. Categories are one-hot; one that a fold's training rows don't have adds nothing.
The penalty holds all weights but the intercept. The table of sums has a row for each day and
category, whatever the rows are, and is solved on the driver; more than MOST rows raise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the table of sums, days times categories, that the driver takes.
MOST = 200_000


def sums_by_day(df: DataFrame, day: Column, numbers: Sequence[str], category: str, target: str) -> DataFrame:
    """(day, category, n, s_i, s_i_j): sums and sums of products of the target and of each number (0 where
    missing) and its being missing. Rows without a day or target are left out."""
    parts = [F.col(target).cast("double")]
    for c in numbers:
        parts += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.col(c).isNull().cast("double")]
    rows = df.where(day.isNotNull() & F.col(target).isNotNull()).select(day.alias("day"), F.coalesce(F.col(category).cast("string"), F.lit("")).alias("category"), *[p.alias(f"x{i}") for i, p in enumerate(parts)])
    k = range(len(parts))
    return rows.groupBy("day", "category").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s_{i}") for i in k], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s_{i}_{j}") for i in k for j in k if i <= j])


@dataclass
class Fit:
    """Weights on the numbers as they are (missing: `fill`), on categories, and the intercept."""

    weights: dict[str, float]
    fill: dict[str, float]
    category: dict[str, float]
    intercept: float

    def predict(self, category: str) -> Column:
        """The prediction as a column."""
        out = F.lit(self.intercept)
        for c, w in self.weights.items():
            out = out + F.coalesce(F.col(c).cast("double"), F.lit(self.fill[c])) * F.lit(w)
        if self.category:
            table = F.create_map(*[F.lit(x) for kv in self.category.items() for x in kv])
            out = out + F.coalesce(table[F.coalesce(F.col(category).cast("string"), F.lit(""))], F.lit(0.0))
        return out


class Sums:
    """The sums of days, running."""

    def __init__(self, table: DataFrame, numbers: Sequence[str]):
        if table.count() > MOST:
            raise ValueError(f"more than {MOST} pairs of day and category")
        rows = table.toPandas().sort_values(["day", "category"])
        self.numbers, self.days, self.categories = list(numbers), sorted(rows["day"].unique()), sorted(rows["category"].unique())
        p, k = 1 + 2 * len(self.numbers), len(self.categories)
        # Per day: counts of categories, sums of parts by category, products of parts.
        n, s, q = np.zeros((len(self.days), k)), np.zeros((len(self.days), k, p)), np.zeros((len(self.days), p, p))
        day, cat = np.searchsorted(self.days, rows["day"]), np.searchsorted(self.categories, rows["category"])
        n[day, cat] = rows["n"]
        for i in range(p):
            s[day, cat, i] = rows[f"s_{i}"]
            for j in range(i, p):
                np.add.at(q, (day, i, j), rows[f"s_{i}_{j}"].to_numpy())
        q += np.triu(q, 1).transpose(0, 2, 1)
        run = lambda x: np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)])
        self.n, self.s, self.q = run(n), run(s), run(q)

    def between(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.n[last] - self.n[first], self.s[last] - self.s[first], self.q[last] - self.q[first]

    def _design(self, n: np.ndarray, s: np.ndarray, q: np.ndarray, fill: np.ndarray) -> np.ndarray:
        """Products of (1, filled numbers, categories, target) from the sums."""
        p, m, k = q.shape[0], len(self.numbers), len(self.categories)
        change = np.zeros((1 + m, p))  # target and filled numbers from the parts
        change[0, 0] = 1
        for i in range(m):
            change[1 + i, 1 + 2 * i], change[1 + i, 2 + 2 * i] = 1, fill[i]
        full = np.zeros((2 + m + k, 2 + m + k))
        products, sums = change @ q @ change.T, s @ change.T  # sums: category x (target, numbers)
        order = [*range(1, 1 + m), 0]
        spots = np.r_[1 : 1 + m, 1 + m + k]
        full[np.ix_(spots, spots)] = products[np.ix_(order, order)]
        full[0, 0], cats = n.sum(), np.arange(1 + m, 1 + m + k)
        full[0, spots] = full[spots, 0] = sums.sum(axis=0)[order]
        full[0, cats] = full[cats, 0] = n
        full[cats, cats] = n
        full[np.ix_(cats, spots)] = sums[:, order]
        full[np.ix_(spots, cats)] = sums[:, order].T
        return full

    def fit(self, first: int, last: int, alpha: float) -> tuple[Fit, np.ndarray]:
        """The fit on days first to last - 1, and its weights on (1, numbers, categories)."""
        n, s, q = self.between(first, last)
        m, total, sums = len(self.numbers), n.sum(), s.sum(axis=0)
        seen = np.array([total - sums[2 + 2 * i] for i in range(m)])
        fill = np.array([sums[1 + 2 * i] / seen[i] if seen[i] else 0.0 for i in range(m)])
        full = self._design(n, s, q, fill)
        mean = full[0, 1:-1] / total
        centred = full[1:-1, 1:-1] - total * np.outer(mean, mean)
        target_mean = full[0, -1] / total
        right = full[1:-1, -1] - total * mean * target_mean
        scale = np.ones(len(mean))
        spread = np.sqrt(np.maximum(np.diag(centred)[:m], 0) / total)
        scale[:m] = np.where(spread > 1e-12 * np.maximum(1, np.abs(mean[:m])), spread, 1.0)
        weights = np.linalg.solve(centred / np.outer(scale, scale) + alpha * np.eye(len(mean)), right / scale) / scale
        weights = np.where(np.r_[np.ones(m, dtype=bool), n > 0], weights, 0.0)
        intercept = target_mean - weights @ mean
        fit = Fit(dict(zip(self.numbers, weights[:m].tolist())), dict(zip(self.numbers, fill.tolist())), dict(zip(self.categories, weights[m:].tolist())), float(intercept))
        return fit, np.r_[intercept, weights]

    def rmse(self, fit: Fit, weights: np.ndarray, first: int, last: int) -> tuple[int, float | None]:
        """(rows, RMSE) of a fit on days first to last - 1, from their sums."""
        n, s, q = self.between(first, last)
        if not n.sum():
            return 0, None
        full = self._design(n, s, q, np.array([fit.fill[c] for c in self.numbers]))
        b = np.r_[weights, -1.0]
        return int(n.sum()), float(np.sqrt(max(b @ full @ b, 0.0) / n.sum()))


def ridge_folds(df: DataFrame, day: Column, numbers: Sequence[str], category: str, target: str, *, alpha: float = 1.0, n_splits: int = 4, min_train_days: int = 4, validation_days: int = 2) -> list[dict]:
    """A dictionary (fold, n_train, n_valid, rmse, fit) for each rolling-origin fold, as sequence.rolling_folds
    has them: windows follow each other up to the last day, a fold trains on all days before its own."""
    sums = Sums(sums_by_day(df, day, numbers, category, target), numbers)
    out, days = [], len(sums.days)
    for fold in range(1, n_splits + 1):
        first = days - (n_splits - fold + 1) * validation_days
        if first < min_train_days:
            continue
        fit, weights = sums.fit(0, first, alpha)
        n_valid, rmse = sums.rmse(fit, weights, first, first + validation_days)
        out.append({"fold": fold, "n_train": int(sums.n[first].sum()), "n_valid": n_valid, "rmse": rmse, "fit": fit})
    return out

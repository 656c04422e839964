"""The minimum covariance determinant search against a plain version of it."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from rivulet.llm import quality

FEATURES = [n for n, _, _ in quality.FEATURES]
FLOORS = [s for _, _, s in quality.FEATURES]


def estimate(x):
    """Centre and Cholesky factor of one group, step by step; also the determinants of the steps taken."""
    bins = np.array([[math.floor(abs(v) * quality.FINE + 0.5) * (1 if v >= 0 else -1) for v in row] for row in x])

    def quantile(column, q):
        column = np.sort(column)
        return column[math.ceil(q * len(column)) - 1] / quality.FINE

    mean = np.array([quantile(bins[:, i], 0.5) for i in range(len(FLOORS))])
    spread = [(quantile(bins[:, i], 0.75) - quantile(bins[:, i], 0.25)) / 1.349 for i in range(len(FLOORS))]
    factor = np.diag([math.sqrt(s**2 + f**2) for s, f in zip(spread, FLOORS)])
    taken = []
    while True:
        y = np.linalg.solve(factor, (x - mean).T)
        bin_ = np.floor(np.log1p((y**2).sum(0)) * quality.FINE)
        order = np.sort(bin_)
        near = x[bin_ <= order[math.ceil(quality.SHARE * len(x)) - 1]]
        new_mean = near.mean(0)
        scatter = (near.T @ near / len(near) - np.outer(new_mean, new_mean)) * quality.CONSISTENCY
        new_factor = np.zeros_like(factor)
        for i in range(len(FLOORS)):
            for j in range(i + 1):
                value = max(scatter[i, i], 0) + FLOORS[i] ** 2 if i == j else scatter[i, j]
                value -= sum(new_factor[i, k] * new_factor[j, k] for k in range(j))
                new_factor[i, j] = math.sqrt(max(value, FLOORS[i] ** 2 / 4)) if i == j else value / new_factor[j, j]
        logdet = 2 * np.log(np.diag(new_factor)).sum()
        if taken and logdet >= taken[-1] - quality.GAIN:
            return mean, factor, taken
        mean, factor = new_mean, new_factor
        taken.append(logdet)


def test_estimates_equal_a_plain_search(spark):
    rng = random.Random(12)
    groups, rows = {}, []
    for g in range(12):
        n = rng.choice([1, 2, 3, 7, 40, 150])
        x = np.array([[rng.gauss(0, 0.5), rng.gauss(1.5, 0.1), abs(rng.gauss(0, 1)) * (g % 2), rng.expovariate(1)] for _ in range(n)])
        x[: n // 5] += 6 * (g % 3)
        x = np.round(x, 3)
        key = f"g{g}" if g else None
        groups[key] = x
        rows += [(key, *map(float, r)) for r in x]
    table = spark.createDataFrame(rows, "g_0 string, " + ", ".join(f"{f} double" for f in FEATURES)).repartition(3)
    got = {r.g_0: r for r in quality.robust_estimates(table, ["g_0"], FEATURES, FLOORS).collect()}
    assert set(got) == set(groups)
    steps = set()
    for key, x in groups.items():
        mean, factor, taken = estimate(x)
        steps.add(len(taken))
        assert all(a > b for a, b in zip(taken, taken[1:]))
        for i in range(len(FLOORS)):
            assert abs(got[key][f"m_{i}"] - mean[i]) < 1e-4
            for j in range(i + 1):
                assert abs(got[key][f"l_{i}_{j}"] - factor[i, j]) < 1e-3
    assert len(steps) > 1  # some groups go on while others are done


def test_the_search_ends_by_itself_on_given_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = quality.quality_verdicts(docs)
    again = quality.quality_verdicts(docs.repartition(7))
    one, two = ({(r.doc_id): (r.kept, r.distance) for r in x.select("doc_id", "kept", "distance").collect()} for x in (judged, again))
    assert one == two and 0 < sum(not kept for kept, _ in one.values()) < len(one) / 2
    assert judged.filter(F.col("base_failed") & F.col("kept")).count() == 0

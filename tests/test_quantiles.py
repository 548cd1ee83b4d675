"""Percentiles by refinement against numpy."""

import random

import numpy as np

from meterflow.plans.quantiles import percentiles


def test_percentiles(spark):
    rng = random.Random(1)
    groups = {
        "ints": [float(rng.randint(0, 9)) for _ in range(500)], "one": [3.5], "two": [1.0, 2.0], "same": [7.0] * 50, "wide": [rng.choice([1, -1]) * 10 ** rng.uniform(-3, 6) for _ in range(200)],
        "near": [1 + k * 2.0**-52 for k in range(40)], "skew": [0.0] * 300 + [1e12, 1.0, 2.0, 3.0], "normal": [rng.gauss(0, 1) for _ in range(3000)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("ints", None), ("none", None)]
    shares = [0.0, 0.5, 0.75, 0.99, 1.0]
    got = {r.g: r.q for r in percentiles(spark.createDataFrame(rows, "g string, x double"), "g", "x", shares, bins=64).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        v = sorted(vs)
        for s, x in zip(shares, got[k]):
            at = s * (len(v) - 1)
            lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
            assert x == lo + (hi - lo) * (at - np.floor(at)), (k, s)
    assert percentiles(spark.createDataFrame([], "g string, x double"), "g", "x", shares).count() == 0

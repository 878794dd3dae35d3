import math

import numpy as np
import pytest

from flowrisk.operators.order_stats import exact_quantiles, exact_ranks


def columns(spark):
    rng = np.random.default_rng(7)
    n = 3000
    data = {
        "uniform": rng.random(n), "heavy": np.exp(rng.normal(0, 8, n)), "ties": rng.integers(0, 4, n).astype(float),
        "negative": -rng.exponential(5, n), "constant": np.full(n, 3.5), "mostly_zero": np.where(rng.random(n) < .9, 0, rng.random(n)),
    }
    rows = [tuple(None if (c != "constant" and rng.random() < .05) else float(data[c][i]) for c in data) for i in range(n)]
    rows.append((None,) * len(data))
    schema = ", ".join(f"{c} double" for c in data) + ", nothing double"
    return spark.createDataFrame([(*r, None) for r in rows], schema), rows, list(data)


@pytest.mark.parametrize("few", [10, 500, 200_000])
@pytest.mark.parametrize("probability", [0.5, 0.99, 0.0, 1.0])
def test_quantiles(spark, few, probability):
    df, rows, names = columns(spark)
    got = exact_quantiles(df, [*names, "nothing"], probability, few)
    assert got["nothing"] is None
    for i, c in enumerate(names):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[c] == pytest.approx(float(np.quantile(values, probability)), rel=1e-12, abs=1e-12), c


@pytest.mark.parametrize("few", [1, 40, 100_000])
def test_ranks_per_group(spark, few):
    rng = np.random.default_rng(3)
    rows = [("big", int(v)) for v in rng.integers(0, 2 ** 60, 2000)] + [("tiny", 5), (None, 9), (None, 7)]
    rows += [("tied", int(v)) for v in rng.integers(0, 3, 500)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = exact_ranks(df, "v", "g", lambda n: [0, n // 2, math.ceil(0.9 * n) - 1, n - 1], few)
    for g in ("big", "tiny", None, "tied"):
        ordered = sorted(v for k, v in rows if k == g)
        n = len(ordered)
        assert got[g] == [ordered[0], ordered[n // 2], ordered[math.ceil(0.9 * n) - 1], ordered[-1]], g


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_ranks(df, "v", "g", lambda n: [0]) == {}
    assert exact_quantiles(df, ["v"], 0.5) == {"v": None}

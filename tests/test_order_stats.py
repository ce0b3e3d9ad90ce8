"""Exact quantiles against numpy and a plain running quantile."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlab.operators import order_stats as osx
from barlab.operators import zigzag as zz


def _groups():
    rng = np.random.default_rng(6)
    return {"normal": rng.normal(size=3_000), "ties": rng.integers(0, 4, 2_001).astype(float), "one": np.array([2.5]),
            "same": np.full(900, 7.0), "two": np.array([1.0] * 500 + [2.0] * 500), "tail": np.exp(rng.normal(size=1_500) * 9),
            "wide": np.array([-1e308, 1e308, 0.0, 1.0, 2.0] * 40), None: rng.random(501), "none": np.array([])}


@pytest.mark.parametrize("buckets,enough", [(1024, 4096), (4, 3), (16, 50)])
def test_group_quantiles(spark, buckets, enough):
    groups = _groups()
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("none", None), ("one", float("nan")), ("same", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    shares = {"q0": 0.0, "q25": 0.25, "median": 0.5, "q60": 0.6, "q99": 0.99, "q100": 1.0}
    got = {r["g"]: r for r in osx.group_quantiles(df, "v", shares, ["g"], buckets=buckets, enough=enough).collect()}
    assert set(got) == {g for g, x in groups.items() if len(x)}
    for g, r in got.items():
        assert r["n"] == len(groups[g])
        for name, q in shares.items():
            if g == "wide" and name not in ("q0", "q100", "median"):
                continue  # numpy's own interpolation overflows there
            assert np.isclose(r[name], np.quantile(groups[g], q), rtol=1e-12), (g, name)


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert osx.group_quantiles(df, "v", {"m": 0.5}, ["g"]).collect() == []


def test_a_large_group_is_never_one_task(spark):
    """Ten million rows in one group: passes shuffle counts, not rows."""
    df = spark.range(10_000_000, numPartitions=16).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 1_000_003).cast("double").alias("v"))
    r = osx.group_quantiles(df, "v", {"m": 0.5, "q": 0.6}, ["g"]).first()
    x = np.sort((np.arange(10_000_000, dtype=np.int64) * 7919) % 1_000_003)
    assert r["n"] == 10_000_000 and r["m"] == np.quantile(x, 0.5) and np.isclose(r["q"], np.quantile(x, 0.6), rtol=1e-12)


def test_fill_with_median(spark):
    rows = [("a", 1.0), ("a", None), ("a", 4.0), ("b", None), (None, 3.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted(((r["g"], r["v"], r["w"]) for r in osx.fill_with_median(df, "v", "w", ["g"]).collect()), key=repr)
    assert got == sorted([("a", 1.0, 1.0), ("a", None, 2.5), ("a", 4.0, 4.0), ("b", None, None), (None, 3.0, 3.0), (None, None, 3.0)], key=repr)


@pytest.mark.parametrize("coarse,fine", [(128, 256), (3, 2)])
def test_quantile_so_far(spark, coarse, fine):
    rng = np.random.default_rng(9)
    many = {"a": rng.gamma(4, 0.3, 1_200), "ties": np.round(rng.random(700), 1), "up": np.arange(500.0), "down": -np.arange(500.0),
            "one": np.array([3.0]), None: rng.normal(size=120), "nulls": np.full(30, np.nan)}
    many["a"][rng.random(1_200) < 0.1] = np.nan
    many["a"][:50] = np.nan
    rows = []
    for g, x in many.items():
        chunk = np.searchsorted(np.sort(rng.choice(len(x), min(40, len(x)), replace=False)), np.arange(len(x)), side="right")
        rows += [(g, int(c), i, None if np.isnan(v) else float(v)) for i, (c, v) in enumerate(zip(chunk, x))]
    df = spark.createDataFrame(rows, "symbol string, dt int, ts int, atr double").repartition(5)
    for q in (0.5, 0.6):
        got = osx.quantile_so_far(df, "atr", q, "gate", coarse=coarse, fine=fine).toPandas().sort_values("ts")
        assert len(got) == len(rows)
        for g, x in many.items():
            part = got[got["symbol"].isna() if g is None else got["symbol"] == g]
            np.testing.assert_allclose(part["gate"].to_numpy(float), zz.quantiles_so_far([], x, q), rtol=1e-12, equal_nan=True)

"""Exact percentiles by distributed selection against numpy and Spark's percentile."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.operators import percentiles
from tally.operators.quantiles import _bucket, exact_percentiles

PS, NAMES = (0.0, 0.5, 0.8, 0.95, 1.0), ("p0", "p50", "p80", "p95", "p100")


def values():
    rnd = random.Random(5)
    out = [("hot", rnd.gauss(0, 1e6)) for _ in range(1500)]
    out += [("ties", 7.0)] * 900 + [("ties", float(rnd.randint(0, 3))) for _ in range(100)]
    out += [("wide", rnd.choice([-1, 1]) * 10.0 ** rnd.randint(-300, 300)) for _ in range(800)]
    out += [("close", 1.0 + i * 2.0 ** -52) for i in range(700)] + [("zero", z) for z in (0.0, -0.0, 5e-324, -5e-324)]
    out += [(None, float(i)) for i in range(50)] + [("none", None)] * 3 + [("one", 3.5), ("two", 1.0), ("two", 2.0)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("buckets", [8, 64, 4096])
def test_equal_to_interpolation_over_sorted_values(spark, buckets):
    df = spark.createDataFrame(values(), "k string, x double").repartition(5)
    got = {r["k"]: tuple(r)[1:] for r in exact_percentiles(df, ["k"], "x", PS, NAMES, buckets=buckets).collect()}
    groups = {}
    for k, x in values():
        groups.setdefault(k, []).append(x)
    assert set(got) == set(groups)
    for k, xs in groups.items():
        xs = [x for x in xs if x is not None]
        if not xs:
            assert got[k] == (None,) * 5
            continue
        for p, g in zip(PS, got[k]):
            s, at = sorted(xs), p * (len(xs) - 1)
            lo, hi = s[math.floor(at)], s[math.ceil(at)]
            want = lo if lo == hi else (math.ceil(at) - at) * lo + (at - math.floor(at)) * hi
            assert g == pytest.approx(want, rel=1e-12, abs=0), (k, p)


def test_equal_to_the_plain_aggregate(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(g), float(x)) for g, x in zip(rng.integers(0, 3, 3000), rng.exponential(1e4, 3000))],
                               "g int, x double")
    a = exact_percentiles(df, ["g"], "x", PS, NAMES, digits=6, buckets=100)
    b = percentiles(df, ["g"], "x", PS, NAMES, digits=6)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_infinities_nan_integers_decimals_no_group_and_no_rows(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in [inf, -inf, 1.0, 2.0, 3.0, 4.0, float("nan")] * 5], "x double")
    got = exact_percentiles(df, [], "x", (0.0, 0.5, 0.75, 1.0), ("a", "b", "c", "d"), buckets=4).first()
    assert got["a"] == -inf and got["b"] == 3.0 and got["c"] == inf and math.isnan(got["d"])
    whole = spark.range(1, 10002).select(F.col("id").cast("decimal(20,2)").alias("x"), F.lit(1).alias("g"))
    assert tuple(exact_percentiles(whole, ["g"], "x", (0.5, 0.25), ("a", "b"), buckets=16).first()) == (1, 5001.0, 2501.0)
    none = df.where("false")
    assert tuple(exact_percentiles(none, [], "x", (0.5,), ("a",)).first()) == (None,)
    assert exact_percentiles(none.withColumn("g", F.lit(1)), ["g"], "x", (0.5,), ("a",)).collect() == []


def test_pieces_never_decrease_with_the_value(spark):
    xs = sorted(x for _, x in values() if x is not None)
    df = spark.createDataFrame([(x, lo, hi) for lo, hi in ((xs[0], xs[-1]), (1.0, 1.5), (-3.0, 1e300))
                                for x in xs if lo <= x <= hi], "x double, lo double, hi double")
    got = df.select("lo", "x", _bucket(F.col("x"), F.col("lo"), F.col("hi"), 50).alias("b")).collect()
    for lo in {r["lo"] for r in got}:
        bs = [r["b"] for r in sorted((r for r in got if r["lo"] == lo), key=lambda r: r["x"])]
        assert bs == sorted(bs) and bs[0] >= 0 and bs[-1] <= 49

"""Time-series operators against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from flowspark.operators.histogram import exact_quantiles, histogram, histogram_quantile
from flowspark.operators.prefix import prefix_sum
from flowspark.operators.series import SECOND, agg_by, difference, hold, instant, rate, ratio

SERIES = ['{"job":"a"}', '{"job":"b"}']


def samples(seed, n=60, spread=4000):
    rnd = random.Random(seed)
    out = []
    for s in SERIES:
        value = 0
        for t in sorted(rnd.sample(range(-200, spread), n)):
            value = rnd.randint(0, 3) if rnd.random() < 0.1 else value + rnd.randint(0, 5)
            out.append((s, t * SECOND, float(value)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "series string, us bigint, value double")


def collected(df):
    return {(r["series"], r["us"]): r["value"] for r in df.collect()}


def grid(rows, step, reach):
    lo, hi = min(r[1] for r in rows), max(r[1] for r in rows)
    first = -(-lo // step) * step
    return range(first, hi + reach, step)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("range_s", "step_s"), [(300, 60), (100, 30), (45, 100)])
def test_rate_simple(spark, seed, range_s, step_s):
    rows = samples(seed)
    want = {}
    for s in SERIES:
        mine = [(t, v) for name, t, v in rows if name == s]
        for t in grid(rows, step_s * SECOND, range_s * SECOND):
            seen = [(u, v) for u, v in mine if t - range_s * SECOND < u <= t]
            if len(seen) >= 2:
                gain = sum(b if b < a else b - a for (_, a), (_, b) in zip(seen, seen[1:]))
                want[s, t] = gain / range_s
    got = collected(rate(frame(spark, rows), range_s=range_s, step_s=step_s, mode="simple"))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_rate_extrapolated(spark):
    # 100 s window, samples every 20 s from 10 s after its start: edges within reach
    rows = [("{}", (10 + 20 * i) * SECOND, 100.0 + 10 * i) for i in range(5)]
    got = collected(rate(frame(spark, rows), range_s=100, step_s=100))
    assert got["{}", 100 * SECOND] == pytest.approx(40 * (100 / 80) / 100)


def test_rate_stops_at_zero(spark):
    # the counter was zero 10 s before the first sample, so no more is added in front
    rows = [("{}", t * SECOND, v) for t, v in [(20, 10.0), (40, 30.0), (60, 50.0)]]
    got = collected(rate(frame(spark, rows), range_s=60, step_s=60))
    assert got["{}", 60 * SECOND] == pytest.approx(40 * (40 + 10) / 40 / 60)


@pytest.mark.parametrize("lookback_s", [300, 40])
def test_instant(spark, lookback_s):
    rows = samples(3)
    want = {}
    for s in SERIES:
        for t in grid(rows, 30 * SECOND, lookback_s * SECOND):
            seen = [(u, v) for name, u, v in rows if name == s and t - lookback_s * SECOND < u <= t]
            if seen:
                want[s, t] = max(seen)[1]
    assert collected(instant(frame(spark, rows), step_s=30, lookback_s=lookback_s)) == want


def test_bounds(spark):
    rows = samples(4)
    whole = collected(rate(frame(spark, rows), range_s=300, step_s=60))
    some = collected(rate(frame(spark, rows), range_s=300, step_s=60, start=600 * SECOND, end=1200 * SECOND))
    assert some == {k: v for k, v in whole.items() if 600 * SECOND <= k[1] <= 1200 * SECOND}


@pytest.mark.parametrize("for_s", [0, 45, 60, 150])
def test_hold(spark, for_s):
    step = 15
    rnd = random.Random(for_s)
    true = [(s, i * step * SECOND, 1.0) for s in SERIES for i in range(400) if rnd.random() < 0.8]
    want = {}
    for s in SERIES:
        since = last = None
        for t in [t for name, t, _ in true if name == s]:
            since = t if last is None or t - last > step * SECOND else since
            last = t
            want[s, t] = "firing" if t - since >= for_s * SECOND else "pending"
    got = hold(frame(spark, true), for_s=for_s, step_s=step).collect()
    assert {(r["series"], r["us"]): r["state"] for r in got} == want
    assert len(got) == len(want)


def test_label_algebra(spark):
    rows = [('{"host":"x","job":"a"}', 0, 4.0), ('{"host":"y","job":"a"}', 0, 2.0)]
    df = frame(spark, rows)
    assert collected(agg_by(df, ["job"], "avg")) == {('{"job":"a"}', 0): 3.0}
    zero = frame(spark, [(s, t, 0.0) for s, t, _ in rows[:1]] + [rows[1]])
    assert collected(ratio(df, zero)) == {(rows[1][0], 0): 1.0}
    assert collected(difference(df, zero))[rows[0][0], 0] == 4.0


def test_histogram_quantile(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 40, 400)], "ms double")
    h = histogram(df, "ms", [10, 100])
    assert [tuple(r) for r in h.orderBy("le").collect()] == [(10.0, 3), (100.0, 4), (float("inf"), 5)]
    assert histogram_quantile(h, 0.5).first()[0] == pytest.approx(10 * 2.5 / 3)
    assert histogram_quantile(h, 0.7).first()[0] == pytest.approx(10 + 90 * 0.5)
    assert histogram_quantile(h, 0.95).first()[0] == 100.0


def test_exact_quantiles_without_groups(spark):
    df = spark.createDataFrame([(x,) for x in [5, 1, 1, 9, 200, 7]], "v0 int")
    q = exact_quantiles(df, "v0", [0.0, 0.5, 1.0], [], F.floor(F.col("v") / 10))
    assert [r["value"] for r in q.orderBy("q").collect()] == [1.0, 6.0, 200.0]


def test_prefix_sum(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), i, rnd.randint(0, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = prefix_sum(df, ["k"], ["o"], F.col("v"), F.floor(F.col("o") / 17), "s").collect()
    for r in got:
        assert r["s"] == sum(v for k, o, v in rows if k == r["k"] and o <= r["o"])


def test_falling_bucket_counts_are_raised(spark):
    rows = [(1.0, 4.0), (2.0, 3.0), (3.0, 10.0), (float("inf"), 9.5)]
    buckets = spark.createDataFrame(rows, "le double, count double")
    # as counts 4, 4, 10, 10: rank 8 lies two thirds into the third bucket
    assert abs(histogram_quantile(buckets, 0.8).first()["value"] - (2 + 4 / 6)) < 1e-9

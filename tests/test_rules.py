"""All rules in one pass against each operator on its own."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from flowspark.operators.histogram import bucket_quantile, histogram_quantile
from flowspark.operators.series import SECOND, agg_by, difference, hold, instant, mapped, rate, ratio, select_series, threshold
from flowspark.plans.alerting import Evaluation, Expression, Reading, Rule, evaluate_rule, evaluate_together

METRICS = "name string, labels map<string,string>, s bigint, value double"


@pytest.fixture(scope="module")
def metrics(spark):
    rnd = random.Random(8)
    rows = []
    for host in ("a", "b"):
        for mode in ("idle", "busy"):
            total = 0.0
            for s in sorted(rnd.sample(range(0, 3600), 200)):
                total = 0.0 if rnd.random() < 0.02 else total + rnd.random() * 4
                rows.append(("cpu", {"host": host, "mode": mode}, s, total))
        for s in range(0, 3600, 20):
            rows += [("free", {"host": host}, s, float(rnd.randint(0, 9))), ("all", {"host": host}, s + 1, float(rnd.randint(0, 9)))]
            rows.append(("up", {"job": host}, s, float(rnd.random() < 0.6)))
    df = spark.createDataFrame(rows, METRICS).repartition(5)
    return df.select("name", "labels", F.timestamp_seconds("s").alias("ts"), "value").cache()


def rule(expr, op, limit, hold_s):
    return Rule(f"r{limit}{op}{hold_s}", "g", expr, op, limit, hold_s, "warning", "s", "{{ $value }}")


def rows(df):
    return sorted((r["series"], r["us"], round(r["value"], 9), r["state"]) for r in df.collect())


def test_one_pass_equals_the_operators(metrics):
    fast, slow = Evaluation(step_s=15, lookback_s=60), Evaluation(step_s=60, range_s=600, mode="simple")
    idle = Reading("cpu", 300, equal=(("mode", "idle"),))
    asked = [
        (rule(Expression(idle, by=("host",), aggregate="avg", scale=-100.0, offset=100.0), ">", 99.0, 45), fast),
        (rule(Expression(Reading("cpu", 300, regex=(("mode", "id.*|b.sy"),)), by=(), aggregate="max"), ">", 0.1, 120), slow),
        (rule(Expression(Reading("free"), Reading("all")), ">=", 0.5, 0), fast),
        (rule(Expression(Reading("free"), Reading("all"), combine="difference"), "<", -1.0, 20), fast),
        (rule(Expression(Reading("up")), "==", 0.0, 60), fast),
        (rule(Expression(Reading("up", equal=(("job", "a"),))), "==", 0.0, 30), fast),
    ]
    s = lambda name, **match: select_series(metrics, name, **match)
    points = [
        (mapped(agg_by(rate(s("cpu", equal={"mode": "idle"})), ["host"], "avg"), lambda v: 100 - 100 * v), 15),
        (mapped(rate(s("cpu"), range_s=600, step_s=60, mode="simple"), lambda v: v).groupBy("us").agg(F.max("value").alias("value")).withColumn("series", F.lit("{}")), 60),
        (ratio(instant(s("free"), lookback_s=60), instant(s("all"), lookback_s=60)), 15),
        (difference(instant(s("free"), lookback_s=60), instant(s("all"), lookback_s=60)), 15),
        (instant(s("up"), lookback_s=60), 15),
        (instant(s("up", equal={"job": "a"}), lookback_s=60), 15),
    ]
    together = evaluate_together(asked, metrics).cache()
    for (r, ev), (value, step) in zip(asked, points):
        want = rows(hold(threshold(value, r.op, r.limit), for_s=r.hold_s, step_s=step))
        assert want and rows(together.filter(F.col("rule") == r.name)) == want
        assert rows(evaluate_rule(r, metrics, ev)) == want


def test_two_exchanges_for_all_rules(metrics):
    asked = [(rule(Expression(Reading("cpu", 300)), ">", float(i), 60 * i), Evaluation()) for i in range(6)]
    asked += [(rule(Expression(Reading("free"), Reading("all")), ">", 0.5, 30), Evaluation(step_s=30))]
    plan = evaluate_together(asked, metrics)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) == 2 and "RangeFrame" not in plan


def test_rates_of_odd_samples(spark):
    nan, inf = float("nan"), math.inf
    samples = [("a", i, v) for i, v in enumerate([1.0, 2.0, nan, 4.0, 5.0, inf, 7.0, None, 8.0, 9.0])]
    df = spark.createDataFrame([(k, i * 10 * SECOND, v) for k, i, v in samples], "series string, us bigint, value double")
    got = {r["us"] // SECOND: r["value"] for r in rate(df, range_s=15, step_s=10, mode="simple").collect()}
    assert sorted(got) == [10, 20, 30, 40, 50, 60, 90]  # a NULL is no sample
    assert all(math.isnan(got[t]) for t in (20, 50)) and got[10] == got[40] == got[90] == 1 / 15


def test_quantile_of_an_array_equals_that_of_rows(spark):
    rnd = random.Random(2)
    cases = [[(float(b), float(rnd.randint(0, 9))) for b in (1, 2, 5, 10)] + [(math.inf, float(rnd.randint(0, 12)))] for _ in range(40)]
    cases += [[(1.0, 0.0), (math.inf, 0.0)], [(math.inf, 3.0)], [(-2.0, 4.0), (math.inf, 4.0)]]
    df = spark.createDataFrame([(i, le, c) for i, case in enumerate(cases) for le, c in case], "g int, le double, count double")
    arrays = df.groupBy("g").agg(F.collect_list(F.struct("le", "count")).alias("b"))
    for q in (0.0, 0.5, 0.95, 1.0):
        want = {r["g"]: r["value"] for r in histogram_quantile(df, q, ["g"]).collect()}
        got = {r["g"]: r["v"] for r in arrays.select("g", bucket_quantile(F.col("b"), F.lit(q)).alias("v")).collect()}
        assert {g: v for g, v in got.items() if g in want} == pytest.approx(want, nan_ok=True)
        assert all(got[g] is None for g in got.keys() - want.keys())

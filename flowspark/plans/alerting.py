"""Alert rules over a metrics table: conditions, hold times, notifications.

A rule is data: which series it reads, how they are combined, its limit and hold time.
All rules are evaluated in one pass: samples are tagged with the readings they belong
to and exchanged once by (reading, series, chunk of time); the points that come out are
exchanged once more by (rule, result's series, chunk), where they are combined,
compared and held.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fence import once
from ..operators.histogram import bucket_quantile
from ..operators.series import CHUNK_WINDOWS, SECOND, compare, label, micros, on_grid, series_key, spread


@dataclass(frozen=True)
class Evaluation:
    """How rules are evaluated: grid step, staleness, rate mode, time bounds in microseconds."""

    step_s: int = 15
    lookback_s: int = 300
    range_s: int | None = None  # overrides the range written in the rules
    hold_s: float | None = None  # overrides the hold time of the rules
    mode: str = "extrapolated"
    start: int | None = None
    end: int | None = None
    digits: int | None = None  # values are rounded to so many places before they are compared

    def __post_init__(self) -> None:
        if self.mode not in ("simple", "extrapolated"):
            raise ValueError(f"unknown mode {self.mode!r}")


@dataclass(frozen=True)
class Reading:
    """Series of one metric: their rates over ``range_s`` seconds, or (0) their newest values."""

    metric: str
    range_s: int = 0
    equal: tuple[tuple[str, str], ...] = ()
    regex: tuple[tuple[str, str], ...] = ()

    def matches(self) -> Column:
        found = F.col("name") == self.metric
        for key, value in self.equal:
            found &= F.col("labels")[key] == value
        for key, pattern in self.regex:
            found &= F.col("labels")[key].rlike(f"^(?:{pattern})$")
        return F.coalesce(found, F.lit(False))


@dataclass(frozen=True)
class Expression:
    """``offset + scale * x``; x is ``left``, its aggregate by labels, its quantile over the label ``le``, or ``left`` and ``right`` combined.

    ``by=None`` keeps the series as they are; both sides of a ratio or difference have equal labels. A
    quantile is taken over the buckets' sums by ``le`` and by the labels in ``by``.
    """

    left: Reading
    right: Reading | None = None
    by: tuple[str, ...] | None = None
    aggregate: str = "sum"
    quantile: float | None = None
    scale: float = 1.0
    offset: float = 0.0
    combine: str = "ratio"  # or "difference"

    def __post_init__(self) -> None:
        if self.combine not in ("ratio", "difference"):
            raise ValueError(f"unknown combination {self.combine!r}")


@dataclass(frozen=True)
class Rule:
    name: str
    group: str
    expr: Expression
    op: str
    limit: float
    hold_s: float
    severity: str
    summary: str
    description: str


def _up(job: str) -> Expression:
    return Expression(Reading("up", equal=(("job", job),)))


#: Percentage of time an instance was not idle.
CPU_USAGE = Expression(Reading("node_cpu_seconds_total", 300, equal=(("mode", "idle"),)), by=("instance",), aggregate="avg", scale=-100.0, offset=100.0)
#: Percentage of memory in use.
MEMORY_USAGE = Expression(Reading("node_memory_MemAvailable_bytes"), Reading("node_memory_MemTotal_bytes"), scale=-100.0, offset=100.0)
#: 95th percentile from the rates of the latency buckets, over all jobs.
LATENCY_P95 = Expression(Reading("latency_ms_bucket", 300), by=(), quantile=0.95)


def intrusion_rules(job: str, source: str) -> list[Rule]:
    """Rules on the detection job ``job`` and its message source ``source``."""
    g = "network_intrusion_detection"
    return [
        Rule(
            "HighIntrusionRate", g, Expression(Reading("intrusions_detected", 300)), ">", 10, 120, "critical",
            "Many intrusions found",
            "{{ $value }} intrusions per second",
        ),
        Rule(
            "JobDown", g, _up(job), "==", 0, 60, "critical",
            "No detection job", "The detection job has not answered for a minute",
        ),
        Rule(
            "SourceDown", g, _up(source), "==", 0, 60, "critical",
            "No message source", "The message source has not answered for a minute",
        ),
        Rule(
            "LowFlowProcessingRate", g, Expression(Reading("total_flows_processed", 300)), "<", 1, 180, "warning",
            "Few flows processed", "Only {{ $value }} flows per second",
        ),
    ]


def infrastructure_rules() -> list[Rule]:
    g = "infrastructure_alerts"
    return [
        Rule(
            "HighCPUUsage", g, CPU_USAGE, ">", 80, 300, "warning",
            "CPU nearly busy", "Instance {{ $labels.instance }} is busy beyond its limit",
        ),
        Rule(
            "HighMemoryUsage", g, MEMORY_USAGE, ">", 90, 300, "critical",
            "Memory nearly full", "Instance {{ $labels.instance }} has little memory left",
        ),
    ]


def session_rules() -> list[Rule]:
    g = "session_scoring"
    return [
        Rule(
            "HighFraudFlagRate", g, Expression(Reading("flagged_sessions_total", 60), scale=60.0), ">", 5, 0,
            "warning", "High rate of flagged sessions", "{{ $value }} sessions per minute are flagged",
        ),
        Rule(
            "PipelineLatencySLABreach", g, LATENCY_P95, ">", 500, 0, "critical",
            "Latency above target", "95th percentile of latency is {{ $value }} ms",
        ),
    ]


def plain_decimal(value: Column) -> Column:
    """A double's shortest digits without an exponent, to 18 places; beyond 20 digits as Spark prints it."""
    text = value.cast("string")
    digits = text.try_cast("decimal(38,18)").cast("string")
    short = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), "[.]$", "")
    return F.coalesce(F.when(short == "-0", F.lit("0")).otherwise(short), text)


def rendered(template: str, labels: Sequence[str] = ("instance", "job", "le")) -> Column:
    """An annotation with ``{{ $value }}`` and ``{{ $labels.x }}`` filled in."""
    text = F.lit(template)
    if "{{ $value }}" in template:
        text = F.replace(text, F.lit("{{ $value }}"), plain_decimal(F.col("value")))
    for name in labels:
        mark = f"{{{{ $labels.{name} }}}}"
        if mark in template:
            text = F.replace(text, F.lit(mark), F.coalesce(label(name), F.lit("")))
    return text


def _by_number(number: Column, values: Sequence[Column]) -> Column:
    """The value that belongs to a rule's or reading's number."""
    return reduce(lambda found, i: found.when(number == i, values[i]), range(1, len(values)), F.when(number == 0, values[0]))


def _choice(number: Column, values: Sequence, kind: str) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), number + 1)


def combined_points(
    asked: Sequence[tuple[Expression, Evaluation]], metrics: DataFrame, copies_s: Sequence[float] | None = None
) -> DataFrame:
    """``rule, series, us, value`` of all expressions, by their number; see the module for the plan.

    ``copies_s`` has how long each one's points matter to later ones: these are copied into
    the next chunk of time, and ``_chunk``, ``_own`` are added. Rows of one (``rule``, ``series``,
    ``_chunk``) are then in one partition.
    """
    wanted: dict[tuple, int] = {}
    uses: list[list[tuple[int, int]]] = []
    for i, (expr, ev) in enumerate(asked):
        for side, reading in enumerate((expr.left, expr.right)):
            if reading is None:
                continue
            span = (ev.range_s or reading.range_s) if reading.range_s else ev.lookback_s
            key = (reading.metric, reading.equal, reading.regex, reading.range_s > 0, ev.step_s, span, ev.mode, ev.start, ev.end)
            number = wanted.setdefault(key, len(wanted))
            if number == len(uses):
                uses.append([])
            uses[number].append((i, side))

    ts = F.col("ts")
    tags = []
    for number, (metric, equal, regex, _, _, span, _, start, end) in enumerate(wanted):
        found = Reading(metric, 0, equal, regex).matches()
        if start is not None:
            found &= ts >= F.timestamp_micros(F.lit(start - span * SECOND))
        if end is not None:
            found &= ts <= F.timestamp_micros(F.lit(end))
        tags.append(F.when(found, F.lit(number)))
    needed = metrics.filter(F.col("name").isin(sorted({key[0] for key in wanted})))
    for bound, ahead in ((7, True), (8, False)):  # the widest bounds reach the scan
        if all(key[bound] is not None for key in wanted):
            limit = min(k[7] - k[5] * SECOND for k in wanted) if ahead else max(k[8] for k in wanted)
            limit = F.timestamp_micros(F.lit(limit))
            needed = needed.filter(ts >= limit if ahead else ts <= limit)
    samples = needed.select(
        F.explode(F.array_compact(F.array(*tags))).alias("_reading"), series_key(F.col("labels")).alias("series"), micros(ts).alias("us"), "value"
    )
    number = F.col("_reading")
    points = on_grid(
        samples,
        keys=("_reading", "series"),
        step=_choice(number, [k[4] * SECOND for k in wanted], "bigint"),
        span=_choice(number, [k[5] * SECOND for k in wanted], "bigint"),
        rated=_choice(number, [k[3] for k in wanted], "boolean"),
        extrapolated=_choice(number, [k[6] == "extrapolated" for k in wanted], "boolean"),
    )
    low, high = ([k[b] for k in wanted] for b in (7, 8))
    if any(b is not None for b in low + high):
        us = F.col("us")
        points = points.filter((us >= F.coalesce(_choice(number, low, "bigint"), us)) & (us <= F.coalesce(_choice(number, high, "bigint"), us)))

    each = F.array(*[F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(s).alias("side")) for i, s in use]) for use in uses])
    points = points.select("series", "us", "value", F.explode(F.element_at(each, number + 1)).alias("_use"))
    rule, side = F.col("rule"), F.col("side")

    def result(expr: Expression) -> Column:
        if expr.by is None:
            return F.col("series")
        return F.to_json(F.struct(*[label(n).alias(n) for n in sorted(expr.by)])) if expr.by else F.lit("{}")

    bound = label("le")
    bound = F.when(bound == "+Inf", F.lit(float("inf"))).otherwise(bound.try_cast("double"))
    quantiles = [e.quantile is not None for e, _ in asked]
    points = points.select(F.col("_use.rule").alias("rule"), F.col("_use.side").alias("side"), "series", "us", "value").withColumns(
        {"series": _by_number(rule, [result(e) for e, _ in asked]), "le": F.when(_choice(rule, quantiles, "boolean"), bound)}
    )
    keys = ["rule", "series", "us"]
    if copies_s is None:
        near = points.repartition("rule", "series", "us")
    else:
        steps = [ev.step_s * SECOND for _, ev in asked]
        reach = [-int(-c * SECOND // s) * s for c, s in zip(copies_s, steps)]
        chunk = _choice(rule, [CHUNK_WINDOWS * max(r, s) for r, s in zip(reach, steps)], "bigint")
        near = spread(points, chunk, ahead=_choice(rule, reach, "bigint")).repartition("rule", "series", "_chunk")
        keys += ["_chunk", "_own"]

    folds = {"sum": F.sum("value"), "avg": F.avg("value"), "max": F.max("value"), "min": F.min("value")}
    used = sorted({e.aggregate for e, _ in asked})
    sums = near.groupBy(*keys, "side", "le").agg(*[folds[a].alias(f"_{a}") for a in used])
    value = reduce(lambda x, a: F.when(_choice(rule, [e.aggregate == a for e, _ in asked], "boolean"), F.col(f"_{a}")).otherwise(x), used[1:], F.col(f"_{used[0]}"))
    sides = sums.withColumn("value", value).groupBy(*keys).agg(
        F.max(F.when(side == 0, F.col("value"))).alias("_left"),
        F.max(F.when(side == 1, F.col("value"))).alias("_right"),
        *([F.collect_list(F.when(F.col("le").isNotNull(), F.struct("le", F.col("value").alias("count")))).alias("_buckets")] if any(quantiles) else []),
    )
    ratios, differences = ([e.right is not None and e.combine == c for e, _ in asked] for c in ("ratio", "difference"))
    x = F.when(_choice(rule, ratios, "boolean"), F.try_divide("_left", "_right"))
    x = x.when(_choice(rule, differences, "boolean"), F.col("_left") - F.col("_right")).otherwise(F.col("_left"))
    if any(quantiles):
        rank = _choice(rule, [e.quantile for e, _ in asked], "double")
        x = F.when(_choice(rule, quantiles, "boolean"), bucket_quantile(F.col("_buckets"), rank)).otherwise(x)
    value = _choice(rule, [e.scale for e, _ in asked], "double") * x + _choice(rule, [e.offset for e, _ in asked], "double")
    values = once(sides, ("_left", "_right", "_buckets"), value=value)
    places = [ev.digits for _, ev in asked]
    if any(d is not None for d in places):
        exact = F.col("value")
        of = {d: exact if d is None else F.round(exact, d) for d in places}
        values = values.withColumn("value", of[places[0]] if len(of) == 1 else _by_number(rule, [of[d] for d in places]))
    return values.filter(F.col("value").isNotNull())


def expression_points(expr: Expression, metrics: DataFrame, ev: Evaluation = Evaluation()) -> DataFrame:
    """``series, us, value`` of one expression at each grid time."""
    return combined_points([(expr, ev)], metrics).drop("rule")


def evaluate_together(asked: Sequence[tuple[Rule, Evaluation]], metrics: DataFrame) -> DataFrame:
    """Pending and firing points of all rules, each at its own step and range, as one stream of alerts.

    A point is pending while the condition has been true at every step for less than the
    rule's hold time, then firing. True stretches are told by the time before, so the
    hold times need no window of their own length.
    """
    holds = [rule.hold_s if ev.hold_s is None else ev.hold_s for rule, ev in asked]
    points = combined_points([(rule.expr, ev) for rule, ev in asked], metrics, holds)
    number, us = F.col("rule"), F.col("us")
    true = _by_number(number, [compare(F.col("value"), rule.op, rule.limit) for rule, _ in asked])
    steps = [ev.step_s * SECOND for _, ev in asked]
    w = W.partitionBy("rule", "series", "_chunk").orderBy("us")
    before = F.lag("us").over(w)
    begins = before.isNull() | (us - before > _choice(number, steps, "bigint"))
    held = points.filter(true).withColumn("_begins", F.when(begins, us))
    since = F.max("_begins").over(w.rowsBetween(W.unboundedPreceding, 0))
    reach = _choice(number, [-int(-h * SECOND // s) * s for h, s in zip(holds, steps)], "bigint")
    held = held.withColumn("_since", since).filter("_chunk = _own")

    def text(of: Callable[[Rule], str]) -> Column:
        return _choice(number, [of(rule) for rule, _ in asked], "string")

    return held.select(
        text(lambda r: r.group).alias("rule_group"),
        text(lambda r: r.name).alias("rule"),
        text(lambda r: r.severity).alias("severity"),
        "series",
        "us",
        "value",
        F.when(us - F.col("_since") >= reach, "firing").otherwise("pending").alias("state"),
        _by_number(number, [rendered(rule.summary) for rule, _ in asked]).alias("summary"),
        _by_number(number, [rendered(rule.description) for rule, _ in asked]).alias("description"),
    )


def evaluate_rule(rule: Rule, metrics: DataFrame, ev: Evaluation = Evaluation()) -> DataFrame:
    return evaluate_together([(rule, ev)], metrics)


def evaluate_alert_rules(
    rules: Sequence[Rule], metrics: DataFrame, ev: Evaluation = Evaluation()
) -> DataFrame:
    """All rules at one step and staleness."""
    return evaluate_together([(rule, ev) for rule in rules], metrics)


def group_notifications(
    alerts: DataFrame, wait_s: int = 30, receiver: str = "slack-alerts"
) -> DataFrame:
    """Firing alerts grouped by ``wait_s`` seconds and receiver.

    An alert is a rule and a series; it counts once per group, however many points of
    the grid it fires at. Title and text appear only where all alerts of a group share
    them. Counts and extremes are enough to tell, so a storm of alerts is never collected.
    """
    width = F.lit(wait_s * SECOND)
    firing = alerts.filter(F.col("state") == "firing")
    keyed = firing.withColumn("group_us", F.col("us") - F.pmod(F.col("us"), width))

    def common(name: str) -> Column:
        return F.when(F.min(name) == F.max(name), F.min(name))

    # the newest point of an alert speaks for it
    each = keyed.groupBy("group_us", "rule_group", "rule", "series").agg(
        F.max_by("summary", "us").alias("summary"), F.max_by("description", "us").alias("description")
    )
    return each.withColumn("receiver", F.lit(receiver)).groupBy("group_us", "receiver").agg(
        F.count(F.lit(1)).alias("n_alerts"),
        common("summary").alias("title"),
        common("description").alias("text"),
    )


def rule_table(spark, rules: Sequence[Rule]) -> DataFrame:
    """Names, labels and thresholds of rules as rows."""
    rows = [
        (r.group, r.name, r.severity, r.op, float(r.limit), float(r.hold_s), r.summary, r.description)
        for r in rules
    ]
    return spark.createDataFrame(
        rows,
        "rule_group string, rule string, severity string, op string, threshold double, "
        "hold_s double, summary string, description string",
    )

"""Hold times on a stream: order, late points, silence and restarts."""

import random

import numpy as np
import pytest

from flowspark.streaming.hold import hold_stream, transitions

SECOND = 1_000_000
SCHEMA = "rule string, series string, us bigint, condition boolean"


def plain(points, reach, silent):
    """The same transitions by a loop; the open stretch at the end stays open."""
    out, since, firing, last = [], None, False, None
    for t, on in points:
        gap = last is not None and silent is not None and t - last > silent
        if since is not None and (not on or gap):
            if firing:
                out.append((since, last + silent if gap else t, "resolved"))
            since, firing = None, False
        if on:
            since = t if since is None else since
            if not firing and t - since >= reach:
                firing = True
                out.append((since, t, "firing"))
        last = t
    return out, since, firing, last


@pytest.mark.parametrize("silent", [None, 4])
def test_transitions_equal_a_loop_in_any_pieces(silent):
    rng = random.Random(3)
    for _ in range(200):
        t = sorted(rng.sample(range(-50, 200), 40))
        points = [(x, rng.random() < 0.8) for x in t]
        want, *end = plain(points, 6, silent)
        got, state = [], (None, False, None)
        cuts = sorted({0, 40, *rng.sample(range(40), 3)})
        for a, b in zip(cuts, cuts[1:]):
            us, on = (np.array(x) for x in zip(*points[a:b]))
            found, *state = transitions(us, on, *state, 6, silent)
            got += [(int(s), int(u), k) for k, (ss, uu) in found.items() for s, u in zip(ss, uu)]
        assert sorted(got) == sorted(want) and state == end


def test_batches_out_of_order_with_silence(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def feed(*points):
        rows = [("r", s, t * SECOND, c) for s, t, c in points]
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)
        held = hold_stream(spark.readStream.schema(SCHEMA).parquet(source), for_s=30, silent_s=60, delay="20 seconds", forget_s=200)
        q = held.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
        q.trigger(availableNow=True).start().awaitTermination()
        rows = [(r.series, r.since_us and r.since_us // SECOND, r.us // SECOND, r.state, r.condition) for r in spark.read.parquet(out).collect()]
        assert len(rows) == len(set(rows))
        return set(rows)

    # one point at two times in one batch, one NULL
    assert feed(("a", 110, True), ("a", 100, True), ("b", 100, None), ("b", 101, True), ("b", 101, False)) == set()
    # 130 fires only once the watermark has passed it; 100 is behind 90 now
    first = ("a", 100, 130, "firing", True)
    assert feed(("a", 130, True), ("a", 120, True), ("b", 160, False)) == {first}
    late = ("a", None, 90, "late", False)
    assert feed(("a", 90, False)) == {first, late}
    # nothing more of series a: 60 s after its last point it resolves, by a timer
    silent = ("a", 100, 190, "resolved", False)
    assert feed(("b", 300, False)) == {first, late, silent}
    # known again after it was forgotten
    assert feed(("b", 900, False)) == {first, late, silent}
    again = feed(("a", 1000, True), ("a", 1040, True), ("b", 1100, False))
    assert again == {first, late, silent, ("a", 1000, 1040, "firing", True)}

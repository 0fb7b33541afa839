"""Best-fit-decreasing packing of indivisible groups into shards of equal bytes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_rank, stored, text_key

#: Runs ``(end, shard)``: groups of one size whose rank is below ``end`` go to ``shard``.
Runs = list[tuple[int, int]]

BROADCAST_CLASSES = 1_000_000
SEARCH_STEPS = 40


class BinTree:
    """Balanced (AA) tree of bins ordered by (room left, bin number)."""

    def __init__(self):
        self.root = None

    def add(self, key):
        self.root = self._add(self.root, key)

    def take_tightest(self, room: int):
        """Remove and return the bin with the least room that is at least ``room``; None if none."""
        node, found = self.root, None
        while node:
            if node[1] >= (room, -1):
                found, node = node[1], node[2]
            else:
                node = node[3]
        if found:
            self.root = self._drop(self.root, found)
        return found

    # a node is [level, key, left, right]
    @staticmethod
    def _skew(t):
        if t and t[2] and t[2][0] == t[0]:
            left = t[2]
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t):
        if t and t[3] and t[3][3] and t[3][3][0] == t[0]:
            right = t[3]
            t[3], right[2] = right[2], t
            right[0] += 1
            return right
        return t

    def _add(self, t, key):
        if t is None:
            return [1, key, None, None]
        side = 2 if key < t[1] else 3
        t[side] = self._add(t[side], key)
        return self._split(self._skew(t))

    def _drop(self, t, key):
        if t is None:
            return None
        if key != t[1]:
            side = 2 if key < t[1] else 3
            t[side] = self._drop(t[side], key)
        elif t[2] is None and t[3] is None:
            return None
        elif t[2] is None:
            near = t[3]
            while near[2]:
                near = near[2]
            t[1], t[3] = near[1], self._drop(t[3], near[1])
        else:
            near = t[2]
            while near[3]:
                near = near[3]
            t[1], t[2] = near[1], self._drop(t[2], near[1])
        low = min(t[2][0] if t[2] else 0, t[3][0] if t[3] else 0) + 1
        if low < t[0]:
            t[0] = low
            if t[3] and t[3][0] > low:
                t[3][0] = low
        t = self._skew(t)
        t[3] = self._skew(t[3])
        if t[3]:
            t[3][3] = self._skew(t[3][3])
        t = self._split(t)
        t[3] = self._split(t[3])
        return t


def pack(classes: Iterable[tuple[int, int]], capacity: int, max_bins: int | None = None) -> tuple[dict[int, Runs], int] | None:
    """Best fit decreasing over ``(size, how many)``, largest first.

    Groups of one size are alike, so each step puts as many as fit into the
    tightest bin: the placement is that of one group at a time. A group larger
    than the capacity gets a bin of its own. Returns the runs of each size and the
    number of bins, or None as soon as more than ``max_bins`` are needed.
    """
    tree, bins, placed = BinTree(), 0, {}
    for size, count in classes:
        done, runs = 0, []
        while done < count:
            found = tree.take_tightest(size)
            if found is None:
                if bins == max_bins:
                    return None
                found = (max(capacity, size), bins)
                bins += 1
            room, b = found
            n = min(count - done, room // size)
            done += n
            runs.append((done, b))
            tree.add((room - n * size, b))
        placed[size] = runs
    return placed, bins


def pack_into(classes: list[tuple[int, int]], shards: int) -> dict[int, Runs]:
    """Pack into at most ``shards`` bins of the least capacity that best fit decreasing can meet.

    A group of at least an even share of what is left takes a shard alone first;
    the capacity is then searched for the others, which makes their shards near equal.
    """
    classes = sorted(classes, reverse=True)
    alone: dict[int, Runs] = {}
    total, used = sum(s * n for s, n in classes), 0
    rest = []
    for size, count in classes:
        n = 0
        while not rest and n < count and used < shards - 1 and size * (shards - used) >= total:
            alone.setdefault(size, []).append((n + 1, used))
            n, used, total = n + 1, used + 1, total - size
        if n < count:
            rest.append((size, count - n))
    if not rest:
        return alone
    bins = shards - used
    low, high = max(-(-total // bins), rest[0][0]), max(total, 1)
    best = None
    width = max(1, total // bins // 1_000_000)  # a millionth of a shard is near enough
    step = width
    while best is None:  # widen from the even share: the answer lies close to it
        best = pack(rest, min(low + step, high), bins)
        if best is None:
            low, step = low + step, step * 4
        else:
            high = min(low + step, high)
    while high - low > width:
        mid = (low + high) // 2
        found = pack(rest, mid, bins)
        if found is None:
            low = mid + 1
        else:
            best, high = found, mid
    placed = {}
    for size, runs in best[0].items():
        first = alone.get(size, [])
        placed[size] = first + [(end + len(first), b + used) for end, b in runs]
    return alone | placed


def shard_by_bytes(docs: DataFrame, shards: int = 16, *, text_col: str = "text", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each row of ``docs`` without its text, with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Size is the text's UTF-8 bytes plus 1 (null: as empty, crc32 0). Rows of equal
    text form an indivisible group. What the driver sees is the histogram of group
    sizes: its D distinct sizes sum to at least D*D/2, so D stays below the square
    root of twice the corpus's bytes. Each group's place among those of its size is
    counted by a distributed rank, and so is each row's gapless ``slot`` in its shard.

    A group larger than an even share makes the largest shard, as no group is split.
    Repeated rows each get a slot of their own; an empty table gives no rows. Input
    columns named like an added one are replaced.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h = text_key(text)
    added = ("size", "text_crc32", "shard", "slot")
    kept = [c for c in docs.columns if c not in (*added, text_col)]
    rows = docs.select(
        F.struct(*kept).alias("_row"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        h[0].alias("_h1"),
        h[1].alias("_h2"),
    )
    rows = stored(rows, "sharding-rows")
    groups = rows.groupBy("_h1", "_h2").agg(F.sum("size").alias("_bytes"))
    groups = global_rank(groups, ["_bytes", "_h1", "_h2"], "_rank", "sharding-groups")
    classes = [(r[0], r[1], r[2]) for r in groups.groupBy("_bytes").agg(F.count(F.lit(1)), F.min("_rank")).collect()]
    placed = pack_into([(b, n) for b, n, _ in classes], shards)
    runs = spark.createDataFrame(
        [(b, first, placed[b]) for b, _, first in classes],
        "_size bigint, _first bigint, _runs array<struct<end: bigint, shard: int>>",
    )
    if len(classes) <= BROADCAST_CLASSES:
        runs = F.broadcast(runs)
    place = F.col("_rank") - F.col("_first")
    at = F.filter("_runs", lambda r: place < r["end"])[0]["shard"]
    groups = groups.join(runs, F.col("_bytes") == F.col("_size")).select(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"), at.alias("shard"))
    # both sides are scans, so that Spark can split the rows of a hot text
    groups = stored(groups, "sharding-placed")
    rows = rows.join(groups, (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2"))).drop("_g1", "_g2")
    rows = rows.withColumns({f"_o{i}": F.col(f"_row.{c}") for i, c in enumerate(order)})
    keys = ["shard", "_h1", "_h2", *(f"_o{i}" for i in range(len(order)))]
    rows = global_rank(rows, keys, "_at", "sharding-slots")
    starts = {r[0]: r[1] for r in rows.groupBy("shard").agg(F.min("_at")).collect()}
    start = F.broadcast(spark.createDataFrame(list(starts.items()), "_s int, _start bigint"))
    rows = rows.join(start, F.col("shard") == F.col("_s"))
    return rows.select("_row.*", "size", "text_crc32", "shard", (F.col("_at") - F.col("_start")).alias("slot"))

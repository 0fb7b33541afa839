"""Benchmark passages in documents: q-gram lemma filter over diagonal bands, banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.session import ship_package

#: Characters of a q-gram; share of an item's characters that may differ; items shorter than this are matched exactly.
#: With these, the lemma promises at least one shared q-gram at the full budget for every length.
Q, ERROR_RATE, MIN_CHARS = 8, 0.1, 40
#: Longer items are also searched by region: stretches of so many characters, each beginning so many after the last.
REGION, REGION_STEP = 240, 120
#: Benchmark text that is sent to every task, at most; a larger benchmark is worked through in parts of this size.
PART_BYTES = 8 << 20
_FOUND = "array<struct<item_id:bigint,start:int,end:int,edits:int>>"


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the text in lower case, with runs of anything but letters and digits as one space; their places in the text."""
    low = text.lower()
    lower = np.frombuffer(low.encode("utf-32-le"), np.uint32) if len(low) == len(text) else np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in text], np.uint32)
    word = _IS_WORD[np.minimum(lower, len(_IS_WORD) - 1)]
    keep = word.copy()
    if len(keep):
        keep[1:] |= word[:-1]
    out = np.where(word, lower, 32)[keep]
    place = np.flatnonzero(keep)
    return out.astype(np.uint32), place


_IS_WORD = np.array([chr(i).isalnum() for i in range(0x3000)] + [True])


def _grams(points: np.ndarray) -> np.ndarray:
    """64-bit value of the q-gram at each place."""
    n = len(points) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p = points.astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(Q):
        out = out * _PRIME + p[i : i + n]
    out ^= out >> np.uint64(31)
    return out * _PRIME


_PRIME = np.array([0x9E3779B97F4A7C15], np.uint64)


@dataclass
class Index:
    """Items of a benchmark part, whole and by region: q-grams sorted by value, with item and place."""

    ids: list[int]
    texts: list[np.ndarray]
    region: list[bool]
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    filter: np.ndarray

    @classmethod
    def build(cls, whole: list[tuple[int, np.ndarray]]) -> Index:
        items, region = [], []
        for i, t in whole:
            starts = sorted({*range(0, len(t) - REGION, REGION_STEP), len(t) - REGION}) if len(t) > REGION else []
            items += [(i, t), *((i, t[a : a + REGION]) for a in starts)]
            region += [False] + [True] * len(starts)
        grams = [_grams(t) for _, t in items]
        value = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(value, kind="stable")
        bits = np.zeros(1 << 22, bool)
        bits[(value >> np.uint64(42)).astype(np.int64)] = True
        return cls([i for i, _ in items], [t for _, t in items], region, value[order], item[order], place[order], bits)


def _banded(a: np.ndarray, b: np.ndarray, shift: int, band: int, limit: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn the whole of ``a`` into some stretch of ``b``, with its start and end.

    Only diagonals ``shift - band .. shift + band`` (place in b minus place in a) are
    filled. None if more than ``limit`` edits are needed.
    """
    width, big = 2 * band + 1, 1 << 20
    first = shift - band
    cost = np.zeros(width, np.int64)  # row 0: a stretch may start anywhere
    start = first + np.arange(width)
    outside = (start < 0) | (start > len(b))
    cost[outside] = big
    steps = np.arange(width)
    for i in range(1, len(a) + 1):
        j = first + i + np.arange(width)  # end in b after i characters of a
        ok = (j >= 1) & (j <= len(b))
        same = np.zeros(width, bool)
        same[ok] = b[j[ok] - 1] == a[i - 1]
        take = np.where((j >= 1) & (j <= len(b)), cost + ~same, big)
        up = np.r_[cost[1:], big] + 1
        up_start = np.r_[start[1:], 0]
        use = up < take
        new = np.where(use, up, take)
        begin = np.where(use, up_start, start)
        new[(j < 0) | (j > len(b))] = big
        # characters of b left over: running minimum of cost minus place
        lead = new - steps
        best = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == best, steps, 0))
        cost, start = best + steps, begin[source]
        if cost.min() > limit:
            return None
    end = first + len(a) + np.arange(width)
    cost[(end < 0) | (end > len(b))] = big
    at = int(cost.argmin())
    return None if cost[at] > limit else (int(cost[at]), max(0, int(start[at])), int(end[at]))


def _budget(n: int) -> int:
    """Edits that an item of n characters may have."""
    return int(n * ERROR_RATE) if n >= MIN_CHARS else 0


def _least(n: int) -> int:
    """Shared q-grams that the lemma promises for an item of n characters with its full edit budget."""
    return max(1, n + 1 - Q * (_budget(n) + 1))


def _masks(want: np.ndarray) -> dict[int, int]:
    """For each character of an item, the bits of its places."""
    out: dict[int, int] = {}
    for i, c in enumerate(want.tolist()):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _within(masks: dict[int, int], n: int, window: list[int], limit: int) -> bool:
    """Whether some stretch of ``window`` is at most ``limit`` edits from the item of n characters (bit vectors of Myers)."""
    top, full = 1 << (n - 1), (1 << n) - 1
    plus, minus, score = full, 0, n
    for c in window:
        same = masks.get(c, 0)
        zero = (((same & plus) + plus) ^ plus) | same | minus
        up, down = minus | ~(zero | plus) & full, plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score <= limit:
                return True
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(zero | up) & full, up & zero
    return n <= limit


class Finder:
    def __init__(self, index: Index):
        self.x = index
        self.least = np.array([_least(len(t)) for t in index.texts], np.int64)
        self.edits = np.array([_budget(len(t)) for t in index.texts], np.int64)
        self.masks: dict[int, dict[int, int]] = {}

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item id, start, end, edits)`` of every stretch that holds a whole item, or regions of one, within the edit budget."""
        found, parts = [], []
        if not text or not len(self.x.grams):
            return found
        points, place = folded(text)
        value = _grams(points)
        if not len(value):
            return found
        maybe = np.flatnonzero(self.x.filter[(value >> np.uint64(42)).astype(np.int64)])
        if not len(maybe):
            return found
        lo = np.searchsorted(self.x.grams, value[maybe])
        hi = np.searchsorted(self.x.grams, value[maybe], "right")
        n = hi - lo
        if not n.sum():
            return found
        at = np.repeat(maybe, n)
        hit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        item, diagonal = self.x.item[hit], at - self.x.place[hit]
        enough = np.bincount(item, minlength=len(self.least)) >= self.least
        if not enough.any():
            return found
        keep = enough[item]
        item, diagonal, at = item[keep], diagonal[keep], at[keep]
        order = np.lexsort((at, diagonal, item))
        item, diagonal, at = item[order], diagonal[order], at[order]
        # the promised q-grams lie on at most e + 1 neighbouring diagonals
        key = item * (1 << 40) + diagonal
        near = np.searchsorted(key, key + self.edits[item], "right") - np.arange(len(key))
        for k in np.unique(item[near >= self.least[item]]):
            a, b = np.searchsorted(item, [k, k + 1])
            hits = self._item(int(k), diagonal[a:b], at[a:b], points, place)
            if self.x.region[k]:
                parts += hits
            else:
                found += hits
        return sorted({*found, *_joined(parts, found)}, key=lambda f: (f[1], f[2], f[0]))

    def _item(self, k: int, diagonal: np.ndarray, at: np.ndarray, points: np.ndarray, place: np.ndarray):
        """Bands of one item: 2e wide, each overlapping the next by half, as the lemma needs.

        An item of n characters with at most e edits shares at least ``n + 1 - q (e + 1)``
        q-grams with its stretch, all within e diagonals of its end's.
        """
        want = self.x.texts[k]
        masks = self.masks.get(k) or self.masks.setdefault(k, _masks(want))
        e, least = int(self.edits[k]), int(self.least[k])
        span, found, last, done = max(1, 2 * e), [], None, []
        for offset in (0, span // 2):
            band = (diagonal + offset) // span
            cut = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
            size = np.diff(np.r_[cut, len(band)])
            for c in np.flatnonzero(size >= least):
                inside = slice(cut[c], cut[c] + size[c])
                if min(len(np.unique(at[inside])), len(np.unique((at - diagonal)[inside]))) < least:
                    continue
                low = int(band[cut[c]]) * span - offset
                middle = low + span // 2
                if any(low <= d < low + span for d in done):
                    continue
                values, often = np.unique(diagonal[inside], return_counts=True)
                d = int(values[often.argmax()])
                if d >= 0 and np.array_equal(points[d : d + len(want)], want):
                    aligned = (0, d, d + len(want))  # the diagonal itself is a match
                    done.append(d)
                    if len(want) < MIN_CHARS and not _stands_alone(points, d, d + len(want)):
                        aligned = None
                elif not e:
                    aligned = None
                else:  # the band's own diagonals and an edit budget on both sides
                    side = span // 2 + e + 1
                    window = points[max(0, middle - side) : max(0, middle + side + len(want) + 1)].tolist()
                    aligned = _banded(want, points, middle, side, e) if _within(masks, len(want), window, e) else None
                if aligned:
                    edits, s, t = aligned
                    if last and s < last[1] and last[0] < t and edits >= last[2]:
                        continue
                    last = (s, t, edits)
                    found.append((self.x.ids[k], int(place[min(s, len(place) - 1)]), int(place[t - 1]) + 1, edits))
        return _best_of(found)


def _stands_alone(points: np.ndarray, start: int, end: int) -> bool:
    """Whether a stretch begins and ends with a word."""
    return (start == 0 or points[start - 1] == 32) and (end >= len(points) or points[end] == 32)


def _joined(parts, whole):
    """Regions of one item that overlap as one stretch, with the most edits of one; without those inside a whole find."""
    out = []
    for f in sorted(parts):
        if any(w[0] == f[0] and f[1] < w[2] and w[1] < f[2] for w in whole):
            continue
        if out and out[-1][0] == f[0] and f[1] <= out[-1][2]:
            last = out[-1]
            out[-1] = (f[0], last[1], max(last[2], f[2]), max(last[3], f[3]))
        else:
            out.append(f)
    return out


def _best_of(found):
    """Of overlapping finds of one item, the one with fewest edits."""
    out = []
    for f in sorted(found, key=lambda f: (f[3], f[1])):
        if all(f[2] <= g[1] or g[2] <= f[1] for g in out):
            out.append(f)
    return out


def _parts(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items long enough to tell, in parts of bounded size; equal texts once, under the smallest id."""
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).cast("string").alias("t"))
    rows = rows.filter("i is not null and t is not null").groupBy("t").agg(F.min("i").alias("i")).orderBy("i")
    part, size = [], 0
    for row in rows.toLocalIterator():
        points, _ = folded(row["t"])
        points = points[np.flatnonzero(points != 32)[0] :] if (points != 32).any() else points[:0]
        if len(points) and points[-1] == 32:
            points = points[:-1]
        if len(points) < Q:
            continue
        part.append((row["i"], points))
        size += 4 * len(points)
        if size >= PART_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def find_passages(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> Column:
    """Column of the benchmark items found in ``text_col``: item, start, end (code points), edits.

    Case, punctuation and white space do not count. An item is found where a stretch of
    the text equals all of it but for at most ``ERROR_RATE`` of its characters, or so
    equals a region of it: any ``REGION`` characters that begin at a multiple of ``REGION_STEP`` or are its
    last, so that ``REGION + REGION_STEP`` characters in a row always hold one. Items of fewer than ``MIN_CHARS``
    folded characters are found where their words stand unchanged. Items of fewer than ``Q``,
    which chance would find anywhere, and those without id or text are ignored. Null
    and empty texts hold nothing. The benchmark reaches the tasks in parts of at most
    ``PART_BYTES``, one pass per part; documents are never exchanged.
    """
    spark = docs.sparkSession
    ship_package(spark)
    columns = []
    for part in _parts(benchmark, item_col, item_text_col):
        columns.append(_finder(spark.sparkContext.broadcast(Index.build(part)))(F.col(text_col).cast("string")))
    return F.concat(*columns) if columns else F.from_json(F.lit("[]"), _FOUND)


def _finder(shared):
    @F.pandas_udf(_FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(shared.value)
        for batch in batches:
            yield pd.Series([[dict(zip(("item_id", "start", "end", "edits"), f)) for f in finder.find(t)] for t in batch])

    return find


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``passages``, ``contaminated`` and ``clean_text`` (without the passages, each leaving a space).

    Input columns named like an added one are replaced; null texts stay null.
    """
    added = ("passages", "contaminated", "clean_text")
    rows = docs.select(*[c for c in docs.columns if c not in added])
    rows = rows.withColumn("passages", find_passages(rows, benchmark, text_col=text_col))
    text = F.col(text_col).cast("string")
    spans = F.array_sort(F.transform("passages", lambda p: F.struct(p["start"], p["end"])))
    state = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))

    def step(acc: Column, p: Column) -> Column:
        # a passage inside one already cut adds nothing
        gap = F.greatest(p["start"] - acc["at"], F.lit(0))
        return F.struct(
            F.concat(acc["kept"], F.substr(text, acc["at"] + 1, gap), F.when(p["end"] > acc["at"], F.lit(" ")).otherwise("")).alias("kept"),
            F.greatest(acc["at"], p["end"]).alias("at"),
        )

    cut = F.aggregate(spans, state, step, lambda acc: F.concat(acc["kept"], F.substr(text, acc["at"] + 1, F.length(text))))
    return rows.select("*", (F.size("passages") > 0).alias("contaminated"), F.when(F.size("passages") > 0, cut).otherwise(text).alias("clean_text"))

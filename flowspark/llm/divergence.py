"""How the sources of a language differ in their words: stripes of counts, merged by term."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from flowspark.session import ship_package

from .common import stored

#: A task's stripes go out once they hold so many cells (frequencies and source counts) or come from so much text.
SPILL_CELLS, SPILL_BYTES = 2_000_000, 256 << 20
_STRIPE = "lang string, term string, df bigint, sources array<string>, counts array<bigint>"
_EMIT = "lang string, source string, part string, item string, value bigint"
_TERM_ROWS = 2048
#: Letters stay (A-Z lower-cased), bytes of other characters stay, all else parts terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of letters and non-ASCII characters, only A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_FOLD).split()


class Stripes:
    """Per (language, term): documents that hold it and occurrences per source.

    Kept as plain counts, ``df[lang][term]`` and ``counts[lang][source][term]``, and put together as they go out.
    """

    def __init__(self) -> None:
        self.df: dict[str, Counter] = {}
        self.counts: dict[str, dict[str, Counter]] = {}
        self.cells = self.bytes = 0

    def add(self, lang: str, source: str, text: str) -> None:
        if lang not in self.df:
            self.df[lang], self.counts[lang] = Counter(), {}
        df, counts = self.df[lang], self.counts[lang].setdefault(source, Counter())
        found, cells = terms(text), len(df) + len(counts)
        counts.update(found)
        df.update(set(found))
        self.cells += len(df) + len(counts) - cells
        self.bytes += len(text)

    def full(self) -> bool:
        return self.cells >= SPILL_CELLS or self.bytes >= SPILL_BYTES

    def spill(self, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
        """All stripes as rows; none are held afterwards."""
        while self.df:
            lang, df = self.df.popitem()
            of = self.counts.pop(lang)
            place = dict(zip(df, range(len(df))))
            names, n = pa.array(list(df), pa.binary()).cast(pa.string()), np.fromiter(df.values(), np.int64, len(df))
            at = np.fromiter((place[t] for c in of.values() for t in c), np.int64)
            source = np.repeat(np.arange(len(of)), [len(c) for c in of.values()])
            count = np.fromiter((x for c in of.values() for x in c.values()), np.int64)
            order = np.argsort(at, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(df)))])
            sources, count = pa.array(list(of), pa.string()).take(pa.array(source[order])), count[order]
            for a in range(0, len(df), rows):
                b = min(a + rows, len(df))
                cells = slice(ends[a], ends[b])
                yield _batch([lang] * (b - a), names[a:b], n[a:b], np.diff(ends[a : b + 1]), sources[cells], count[cells])
        self.cells = self.bytes = 0


def _batch(lang, term, df, lengths, sources, counts) -> pa.RecordBatch:
    """A batch of stripes; ``lengths`` says how many of the flat sources and counts belong to each."""

    def column(x, kind):
        return x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind)

    ends = pa.array(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, column(x, t)) for x, t in ((sources, pa.string()), (counts, pa.int64()))]
    columns = [column(lang, pa.string()), column(term, pa.string()), column(df, pa.int64()), *lists]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "df", "sources", "counts"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents into stripes; a row without a term names the groups a task has seen."""
    stripes, seen = Stripes(), {}
    for b in batches:
        for lang, source, text in zip(*[b.column(c).to_pylist() for c in ("lang", "source", "text")]):
            groups = seen.setdefault(lang, Counter())
            groups[source] += 1
            stripes.add(lang, source, text)
            if stripes.full():
                yield from stripes.spill()
    yield from stripes.spill()
    if seen:
        flat = [(s, n) for groups in seen.values() for s, n in groups.items()]
        lengths = [len(groups) for groups in seen.values()]
        yield _batch(list(seen), [None] * len(seen), [0] * len(seen), lengths, [s for s, _ in flat], [n for _, n in flat])


def _merge(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring stripes of one key into one; the rows come sorted by key. Terms of too few documents end here.

    Document frequencies are summed for whole batches; sources only for the keys that stay.
    The last key of a batch waits for the next one.
    """
    rest = None
    for b in batches:
        if not len(b):
            continue
        flat = [b.column(c).flatten() for c in ("sources", "counts")]
        b = _batch(*[b.column(c) for c in ("lang", "term", "df")], pc.list_value_length(b.column("sources")), *flat)
        whole = b if rest is None else pa.concat_batches([rest, b])
        firsts = _firsts(whole)
        cut = int(firsts[-1])
        if cut:
            yield _merged(whole.slice(0, cut), least_docs)
        rest = whole.slice(cut)
        if len(rest) > 1:
            rest = _merged(rest, 0)
    if rest is not None:
        yield _merged(rest, least_docs)


def _firsts(b: pa.RecordBatch) -> np.ndarray:
    """Rows at which another key begins."""
    new = np.zeros(len(b), bool)
    new[0] = True
    for c in ("term", "lang"):
        x = b.column(c)
        one, other = x[1:], x[:-1]
        differ = pc.if_else(pc.or_(one.is_null(), other.is_null()), pc.xor(one.is_null(), other.is_null()), pc.not_equal(one, other))
        new[1:] |= differ.to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(new)


def _merged(b: pa.RecordBatch, least_docs: int) -> pa.RecordBatch:
    """One stripe per key; keys without a term always stay."""
    firsts = _firsts(b)
    ends = np.append(firsts[1:], len(b))
    df = np.add.reduceat(b.column("df").to_numpy(), firsts)
    stay = np.flatnonzero((df >= least_docs) | b.column("term").take(pa.array(firsts)).is_null().to_numpy(zero_copy_only=False))
    sources, counts, lengths = [], [], []
    for i in stay:
        total: Counter = Counter()
        part = b.slice(firsts[i], ends[i] - firsts[i])
        for s, n in zip(part.column("sources").flatten().to_pylist(), part.column("counts").flatten().to_pylist()):
            total[s] += n
        sources += total
        counts += total.values()
        lengths.append(len(total))
    at = pa.array(firsts[stay])
    return _batch(b.column("lang").take(at), b.column("term").take(at), df[stay], lengths, sources, counts)


def share(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), exactly; Python integers where 64 bits could not hold it."""
    if counts.size and int(counts.max()) + 5 >= (1 << 63) // 10**9:
        counts = counts.astype(object)
    return (1 + 10**9 * (counts + 5) // (total + 5 * kept)).astype(np.int64)


class _Language:
    """One language's running sums: pair distances, and each group's strongest terms."""

    def __init__(self, sources: list[str], totals: list[int], kept: int, top: int) -> None:
        self.sources, self.kept, self.top = sources, kept, top
        self.at = {s: i for i, s in enumerate(sources)}
        self.totals = np.array(totals, np.int64)
        self.pairs = np.zeros((len(sources), len(sources)), np.int64)
        self.best: list[list[tuple[int, str]]] = [[] for _ in sources]

    def add(self, names: list[str], stripes: list[tuple]) -> None:
        counts = np.zeros((len(names), len(self.sources)), np.int64)
        for row, (sources, values) in enumerate(stripes):
            counts[row, [self.at[s] for s in sources]] = values
        p = share(counts, self.totals[None], self.kept)
        q = share(counts.sum(1), self.totals.sum(), self.kept)
        for i in range(len(self.sources)):
            self.pairs[i] += np.abs(p[:, i, None] - p).sum(0)
            rows = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
            over = p[rows, i] - q[rows]
            if len(rows) > self.top:  # the cut keeps all ties of its last value
                least = np.partition(over, len(over) - self.top)[len(over) - self.top]
                rows, over = rows[over >= least], over[over >= least]
            found = self.best[i] + [(-int(v), names[r]) for r, v in zip(rows, over)]
            self.best[i] = sorted(found, key=lambda x: (x[0], x[1].encode()))[: self.top]

    def rows(self, lang: str) -> Iterator[pd.DataFrame]:
        for i, a in enumerate(self.sources):
            out = [(lang, a, "pair", b, int(self.pairs[i, j])) for j, b in enumerate(self.sources) if i != j]
            out += [(lang, a, "term", t, -v) for v, t in self.best[i]]
            yield pd.DataFrame(out, columns=["lang", "source", "part", "item", "value"])


def stripes(docs: DataFrame, least_docs: int = 1) -> DataFrame:
    """``lang, term, df, sources, counts``: one stripe per term that ``least_docs`` documents of a language hold, and one without a term per language.

    The stripe without a term holds all sources of the language with their documents.
    Each task folds its documents into a hash table, which goes out when it is full;
    the parts meet by (language, term), sorted, and are added up as they stream by.
    Null texts, languages and sources count as empty.
    """
    ship_package(docs.sparkSession)
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = read.mapInArrow(_fold, _STRIPE)
    near = parts.repartition("lang", "term").sortWithinPartitions("term", "lang")
    return near.mapInArrow(lambda batches: _merge(batches, least_docs), _STRIPE)


def divergences(docs: DataFrame, *, least_docs: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``: what tells the sources of a language apart.

    Terms of a language are kept if ``least_docs`` of its documents hold them. A
    group (language, source) and each language give each kept term the share
    ``1 + floor(10^9 (count + 5) / (N + 5 V))``. Part ``pair``: each other source of
    the language, with the distance of the shares summed over all kept terms (0
    without any). Part ``term``: kept terms whose share in the group is above the
    language's, the ``top`` with the largest excess. Ranks go from 1 by falling value,
    then by the item's UTF-8. All arithmetic is exact.

    Null text, lang and source count as ''. A language with one source has no pairs;
    documents without terms still make their group; an empty table gives no rows;
    repeated rows are so many documents; other columns are left alone. The list of
    groups is sent to all tasks: it is the square root of the pairs that come out.
    """
    spark = docs.sparkSession
    kept = stored(stripes(docs, least_docs), "divergence-stripes")
    cells = kept.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    counted = F.when(F.col("term").isNotNull(), F.col("c.counts")).otherwise(0)
    totals = cells.groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum(counted).alias("n"))
    sizes = {r["lang"]: r["v"] for r in kept.groupBy("lang").agg(F.count("term").alias("v")).collect()}
    groups: dict[str, tuple[list[str], list[int]]] = {}
    for r in totals.collect():
        names, ns = groups.setdefault(r["lang"], ([], []))
        names.append(r["source"])
        ns.append(r["n"])
    known = spark.sparkContext.broadcast({lang: (*g, sizes[lang]) for lang, g in groups.items()})

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs: dict[str, _Language] = {}
        for b in batches:
            for lang, same in b.groupby("lang", sort=False):
                if lang not in langs:
                    for other, done in langs.items():  # the rows come sorted by language
                        yield from done.rows(other)
                    langs = {lang: _Language(*known.value[lang], top)}
                same = same[same.term.notna()]
                for at in range(0, len(same), _TERM_ROWS):
                    cut = same.iloc[at : at + _TERM_ROWS]
                    langs[lang].add(list(cut.term), list(zip(cut.sources, cut.counts)))
        for lang, done in langs.items():
            yield from done.rows(lang)

    found = kept.sortWithinPartitions("lang").mapInPandas(emit, _EMIT)
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(best).select("lang", "source", "part", "item", "value", "rank")

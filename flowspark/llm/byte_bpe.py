"""Byte-level BPE: words folded in Spark's higher-order functions, texts put together from their words."""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.session import ship_package

from .common import stored

#: The dictionary that every task holds: at most so many of the most frequent words, of at most so many bytes each.
DICTIONARY_WORDS, DICTIONARY_BYTES = 200_000, 32
#: Frequent words are folded in so many groups, each beside one copy of the rank map.
FOLD_GROUPS = 96
#: Other words above this many bytes take a heap: merging the rest side by side costs the square of the longest.
SIDE_BYTES = 64
#: Words put together at a time; a text with more is taken whole.
SLICE_WORDS = 250_000
_IDS = 1 << 16
_PLACE_BITS = 10


@dataclass(frozen=True)
class ByteRanks:
    """A rank file: token bytes by id; ids are ranks."""

    tokens: dict[bytes, int]

    @classmethod
    def read(cls, path: str) -> ByteRanks:
        with open(path, "rb") as f:
            found = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        if any(bytes([b]) not in found for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")
        return cls(found)

    def pairs(self) -> Iterator[tuple[int, int, int]]:
        """Every (left, right) of tokens that together are a token, with that token."""
        for token, rank in self.tokens.items():
            for k in range(1, len(token)):
                a, b = self.tokens.get(token[:k]), self.tokens.get(token[k:])
                if a is not None and b is not None:
                    yield a, b, rank


def _literal(value, kind: str) -> Column:
    """A constant that Catalyst folds into one literal object, whatever its size."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _displaced(pairs: Iterable[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The rank map as two flat arrays in which a pair is found in one probe.

    The pairs of one left id are a row, placed at a shift of its own where none of its
    cells is taken: pair (a, b) has slot ``shifts[a] + b``. A slot holds one more than the left id,
    and the rank of 16 bits, above the bits of a place; an empty one holds 0.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for a, b, rank in pairs:
        if max(a, b, rank) >= _IDS - 1:
            raise ValueError("ids above 16 bits")
        rows.setdefault(a, []).append((b, rank))
    size = 8 * _IDS + 2 * sum(map(len, rows.values()))
    shifts, slots, lowest, span = np.zeros(_IDS, np.int64), np.zeros(size, np.int64), 0, 4096
    free = np.ones(size, bool)
    for a, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        row.sort()
        cells = np.array([b for b, _ in row])
        start = max(lowest, cells[0])
        while True:  # the first shift in the next free cells at which the whole row is free
            at = np.flatnonzero(free[start : start + span]) + start - cells[0]
            for b in cells[1:]:
                at = at[free[at + b]]
            if len(at):
                break
            start += span
        shifts[a] = at[0]
        slots[at[0] + cells] = (a + 1 << 16 | np.array([rank for _, rank in row])) << _PLACE_BITS
        free[at[0] + cells] = False
        lowest += int(np.argmax(free[lowest:]))
    return shifts, slots[: shifts.max() + _IDS]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def java_pattern(pattern: str) -> str:
    """The pattern with white space as Unicode has it, which Java's ``\\s`` leaves out."""
    inside = pattern.replace(r"[^\s", r"[^\p{IsWhite_Space}")
    return inside.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


class Codec:
    """Encoding and decoding expressions for one rank file and one splitting pattern."""

    def __init__(self, ranks: ByteRanks, pattern: str):
        self.ranks, self.pattern = ranks, java_pattern(pattern)
        self.shifts, self.slots = _displaced(ranks.pairs())
        self._bytes = _literal([ranks.tokens[bytes([b])] for b in range(256)], "array<bigint>")

    @cached_property
    def _hex(self) -> Column:
        hexes = [""] * (max(self.ranks.tokens.values()) + 1)
        for token, rank in self.ranks.tokens.items():
            hexes[rank] = token.hex()
        return _literal(hexes, "array<string>")

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def maps(self, spark: SparkSession) -> DataFrame:
        """The rank map as a table of one row.

        As literals its arrays would stand in every text of the plan, which the driver makes and keeps for each
        query and again for each adaptive step, as boxed numbers and as digits.
        """
        columns = {"_shifts": self.shifts, "_slots": self.slots}
        return spark.createDataFrame(pa.table({c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for c, x in columns.items()}))

    def folded(self, words: DataFrame) -> DataFrame:
        """``w, ids`` for each row of ``words`` (its column ``w``): many words meet one copy of the rank map."""
        group = F.pmod(F.xxhash64("w"), F.lit(FOLD_GROUPS)).alias("_group")
        groups = words.groupBy(group).agg(F.collect_list("w").alias("_words")).crossJoin(F.broadcast(self.maps(words.sparkSession)))

        def each(shifts: Column, slots: Column) -> Column:
            return F.transform("_words", lambda w: F.struct(w.alias("w"), self.fold(w, shifts, slots).alias("ids")))

        return groups.select(F.inline(_let(F.col("_shifts"), lambda shifts: _let(F.col("_slots"), lambda slots: each(shifts, slots)))))

    def fold(self, word: Column, shifts: Column, slots: Column) -> Column:
        """Ids of one pre-token: its bytes, with the lowest-ranked pair merged again and again.

        The leftmost goes first among equals. A step finds the least rank with its place;
        the fold stands still once no pair is left.
        """
        as_bytes = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
        start = F.transform(F.split(as_bytes, ""), lambda c: F.get(self._bytes, F.ascii(c)))

        def best(p: Column) -> Column:
            def key(x: Column, i: Column) -> Column:
                slot = F.get(slots, F.get(shifts, x) + F.get(p, i + 1))
                # a slot of this left id leaves its rank, any other something above all ranks
                return slot.bitwiseXOR(F.shiftleft(x + 1, 16 + _PLACE_BITS)).bitwiseOR(i)

            return F.array_min(F.transform(p, key))

        def merge(p: Column, at: Column) -> Column:
            def put(place: Column) -> Column:
                merged = F.transform(p, lambda x, i: F.when(i == place, F.shiftright(at, _PLACE_BITS)).otherwise(x))
                return F.filter(merged, lambda _, i: i - 1 != place)

            return _let(at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int"), put)

        def step(p: Column, _: Column) -> Column:
            return _let(best(p), lambda at: F.when(at < (1 << 16 + _PLACE_BITS), merge(p, at)).otherwise(p))

        steps = F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))
        return F.aggregate(steps, start, step)

    def decode(self, ids: Column) -> Column:
        """The bytes of a column of ids: their pieces one after another. Null for an id that does not exist."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self._hex, i.cast("int"))), ""))


def heap_encode(word: bytes, tokens: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token of any length, in n log n steps."""
    n = len(word)
    end, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

    def offer(i):
        j = end[i]
        if j < n and (rank := tokens.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n):
        offer(i)
    alive = [True] * n
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j]) or end[i] != j or end[j] != k:
            continue
        alive[j], end[i] = False, k
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [tokens[word[i : end[i]]] for i in range(n) if alive[i]]


class Encoder:
    """What a task needs to give every word its ids: the dictionary, and the rank map for words outside it."""

    def __init__(self, codec: Codec, words: pa.Array, ids: pa.ListArray) -> None:
        self.tokens, self.shifts, self.slots = codec.ranks.tokens, codec.shifts, codec.slots
        self.bytes = np.array([self.tokens[bytes([b])] for b in range(256)])
        self.words, self.lengths = words, pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int32)
        self.ids = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        pieces = [b""] * (max(self.tokens.values()) + 1)
        for token, rank in self.tokens.items():
            pieces[rank] = token
        self.pieces, self.piece_lengths = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces], np.int32)

    def texts(self, words: pa.ListArray) -> pa.Array:
        """``ids`` and ``decoded`` of each text from its words, so many words at a time."""
        ends, cuts = words.offsets.to_numpy(), [0]
        while cuts[-1] < len(words):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, ends[cuts[-1]] + SLICE_WORDS, "right")) - 1))
        parts = [self.some_texts(words[a:b]) for a, b in zip(cuts, cuts[1:])]
        both = [pa.StructArray.from_arrays([ids, self.decoded(ids)], names=["ids", "decoded"]) for ids in parts]
        return pa.concat_arrays(both or [pa.array([], pa.struct({"ids": pa.list_(pa.int64()), "decoded": pa.binary()}))])

    def decoded(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids: their pieces one after another."""
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        lengths = self.piece_lengths[flat].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        begins = np.cumsum(self.piece_lengths, dtype=np.int64) - self.piece_lengths
        data = self.pieces[np.arange(ends[-1]) + np.repeat(begins[flat] - ends[:-1], lengths)]
        offsets = ends[ids.offsets.to_numpy() - ids.offsets[0].as_py()].astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def some_texts(self, words: pa.ListArray) -> pa.ListArray:
        """Every distinct word is looked up, or merged, once."""
        coded = words.flatten().dictionary_encode()
        distinct, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        known = pc.index_in(distinct, value_set=self.words)
        new = known.is_null().to_numpy(zero_copy_only=False)
        fresh, fresh_lengths = self.merged(distinct.filter(pa.array(new)).cast(pa.binary()))
        # the ids of all distinct words lie in the dictionary's, then the new words'
        starts, lengths = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        place = known.filter(pa.array(~new)).to_numpy(zero_copy_only=False)
        starts[~new], lengths[~new] = (np.cumsum(self.lengths, dtype=np.int64) - self.lengths)[place], self.lengths[place]
        starts[new], lengths[new] = len(self.ids) + np.cumsum(fresh_lengths) - fresh_lengths, fresh_lengths
        pool = np.concatenate([self.ids, fresh])
        per_word = lengths[at]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        flat = pool[np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], per_word)]
        offsets = words.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(ends[offsets - offsets[0]], pa.int32()), pa.array(flat))

    def merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after another, and how many each has.

        The words are merged side by side: in each round every word that has a pair merges its
        lowest, leftmost first, as the fold does.
        """
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        long = {i: heap_encode(words[i].as_py(), self.tokens) for i in np.flatnonzero(sizes > SIDE_BYTES)}
        short = np.flatnonzero(sizes <= SIDE_BYTES)
        data = b"".join(words.take(pa.array(short)).to_pylist())
        symbols, word = self.bytes[np.frombuffer(data, np.uint8)], np.repeat(short, sizes[short])
        done = [(np.array(ids, np.int64), np.full(len(ids), i)) for i, ids in long.items()]
        none = 1 << 16 + _PLACE_BITS
        while len(symbols):
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            # the rank of each symbol with the next, above its place in the word
            follow = np.append(symbols[1:], 0)
            rank = self.slots[self.shifts[symbols] + follow] ^ (symbols + 1 << 16 + _PLACE_BITS)
            rank[np.append(begins[1:], len(symbols)) - 1] = none
            counts = np.diff(np.append(begins, len(symbols)))
            place = np.arange(len(symbols)) - np.repeat(begins, counts)
            least = np.minimum.reduceat(np.minimum(rank | place, none), begins)
            more = least < none
            at = begins[more] + (least[more] & (1 << _PLACE_BITS) - 1)
            symbols[at] = least[more] >> _PLACE_BITS
            stay = np.repeat(more, counts)
            done.append((symbols[~stay], word[~stay]))
            stay[at + 1] = False
            symbols, word = symbols[stay], word[stay]
        ids, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*done) if done else ((), ())))
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def _dictionary(docs: DataFrame, codec: Codec, words: int) -> DataFrame:
    """``w, ids`` of the most frequent words of the corpus, each folded once.

    All words are counted. The cut is the least count above which at most ``words``
    stay, so the table that is sent to the tasks has a fixed bound.
    """
    counts = docs.select(F.explode(codec.words(F.col("_text"))).alias("w"))
    counts = counts.filter(F.octet_length("w") <= DICTIONARY_BYTES).groupBy("w").count()
    counts = stored(counts.filter(F.col("count") > 1), "bpe-words")
    by_count = counts.groupBy("count").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("count"))
    total, least = 0, None
    for row in by_count.limit(words).toLocalIterator():
        total += row["n"]
        if total > words:
            break
        least = row["count"]
    frequent = counts.filter(F.col("count") >= least if least is not None else F.lit(False))
    return codec.folded(frequent)


def encode_bytes(docs: DataFrame, ranks_path: str, pattern: str, *, text_col: str = "text", dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """``docs`` with ``ids`` (array of bigint) and ``decoded`` (the bytes of those ids).

    Each match of ``pattern`` is encoded by itself, without special tokens; text
    between matches has no ids. Null and empty texts: no ids, no bytes. Distinct
    words that are frequent are folded once for the corpus and sent to all tasks; the rarer
    ones, which no bounded table holds, are merged once per batch of texts, side by
    side, and above ``SIDE_BYTES`` bytes by ``heap_encode``. Texts are never exchanged. Input
    columns named like an added one are replaced.
    """
    spark = docs.sparkSession
    ship_package(spark)
    codec = Codec(ByteRanks.read(ranks_path), pattern)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in ("ids", "decoded")]).alias("_row"), text.alias("_text"))
    known = _dictionary(rows, codec, dictionary_words).toArrow()
    words, ids = (known.column(c).combine_chunks() for c in ("w", "ids"))
    encoder = spark.sparkContext.broadcast(Encoder(codec, words.cast(pa.string()), ids))

    @F.arrow_udf("ids array<bigint>, decoded binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield encoder.value.texts(batch)

    rows = rows.select("_row", encode(codec.words(F.col("_text"))).alias("_found"))
    return rows.select("_row.*", "_found.ids", "_found.decoded")

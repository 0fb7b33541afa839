"""Token counts of a BPE model with byte fallback, by merging ragged arrays of symbols."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.session import ship_package

SPACE = "▁"
_NONE = np.int64(1 << 40)
_RUNS = re.compile(" *[^ ]+| +")
CACHE_WORDS, CACHE_CHARS, BATCH_CHARS, SPLIT_CHARS = 400_000, 64, 500_000, 2_000_000


@dataclass
class PieceRanks:
    """Merges of a vocabulary. Symbols are numbered; ``chars`` maps a code point to its symbol.

    ``pairs``: sorted keys ``left * n_symbols + right``; ``merged``/``ranks``: what each
    makes and how early. ``inner``: sorted keys of the characters that stand side by
    side in some piece; elsewhere no merge can reach across. ``risky``: symbols
    that can merge on earlier than they themselves were made.
    """

    chars: dict[int, int]
    n_symbols: int
    pairs: np.ndarray
    merged: np.ndarray
    ranks: np.ndarray
    inner: np.ndarray
    risky: np.ndarray


def load_pieces(path: str) -> PieceRanks:
    """Read the pieces and scores of a sentencepiece BPE model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    if not any(map(sp.is_byte, ids)):
        raise ValueError("the model has no byte pieces")
    plain = [i for i in ids if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i))]
    score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in score):
        raise ValueError("a piece holds a space behind another character")
    order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
    singles = sorted(set("".join(score)))
    symbols = {p: i for i, p in enumerate([*singles, *(p for p in score if len(p) > 1)])}
    rank = {p: order[s] for p, s in score.items()}
    n = len(symbols)
    pairs, inner, risky = [], set(), np.zeros(n, bool)
    for piece, r in rank.items():
        for k in range(1, len(piece)):
            a, b = piece[:k], piece[k:]
            inner.add(symbols[a[-1]] * n + symbols[b[0]])
            if a in symbols and b in symbols:
                pairs.append((symbols[a] * n + symbols[b], symbols[piece], r))
                for x in (a, b):
                    risky[symbols[x]] |= len(x) > 1 and rank[x] > r
    keys, merged, ranks = (np.array(x, np.int64) for x in zip(*sorted(pairs)))
    # a character that is no piece of its own falls back to bytes, whatever it is part of
    lone = {ord(c): symbols[c] for c in singles}
    if any(c not in score for c in singles):
        raise ValueError("a character of a longer piece is no piece")
    return PieceRanks(lone, n, keys, merged, ranks, np.array(sorted(inner), np.int64), risky)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


class PieceCounter:
    """Counts the tokens of many pre-tokens at once."""

    def __init__(self, ranks: PieceRanks):
        self.r = ranks
        self.symbol = np.full(0x110000, -1, np.int32)
        self.symbol[list(ranks.chars)] = list(ranks.chars.values())
        self.seen: dict[str, int] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at, ok = _find(self.r.pairs, a * self.r.n_symbols + b)
        return np.where(ok & (a >= 0) & (b >= 0), self.r.ranks[at], _NONE)

    def words(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token (spaces already marked), in batches of bounded length."""
        out, start, size = [], 0, 0
        for i, w in enumerate(words):
            if size and size + len(w) > BATCH_CHARS:
                out.append(self._merge(words[start:i]))
                start, size = i, 0
            size += len(w)
        out.append(self._merge(words[start:]))
        return np.concatenate(out)

    def _merge(self, words: list[str]) -> np.ndarray:
        counts = np.zeros(len(words), np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        if not len(points):
            return counts
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        sym = self.symbol[points].astype(np.int64)
        unknown = sym < 0
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        counts += np.bincount(word, np.where(unknown, width - 1, 0), len(words)).astype(np.int64)
        # sequences end with their word, and wherever no piece holds the two characters
        a, b = sym[:-1], sym[1:]
        _, joined = _find(self.r.inner, a * self.r.n_symbols + b)
        cut = np.ones(len(sym), bool)
        cut[1:] = (word[1:] != word[:-1]) | ~joined | unknown[:-1] | unknown[1:]
        seq = np.cumsum(cut) - 1
        rank = np.full(len(sym), _NONE)
        inside = np.flatnonzero(~cut[1:])
        rank[inside] = self._rank(sym[inside], sym[inside + 1])
        while True:
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(seq)])
            going = low < _NONE
            if not going.all():  # finished sequences leave with their symbols counted
                stay = np.repeat(going, lengths)
                counts += np.bincount(word[~stay], minlength=len(words))
                word, sym, seq, rank = word[stay], sym[stay], seq[stay], rank[stay]
                low, lengths = low[going], lengths[going]
                if not len(seq):
                    return counts
                starts = np.r_[0, np.cumsum(lengths)[:-1]]
            hit = np.flatnonzero(rank == np.repeat(low, lengths))
            # of pairs that overlap, every other one from the left
            run = np.r_[True, np.diff(hit) != 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            at, _ = _find(self.r.pairs, sym[hit] * self.r.n_symbols + sym[hit + 1])
            made = self.r.merged[at]
            # a symbol that could merge on at once must do so before its twins are made
            leading = np.r_[True, seq[hit[1:]] != seq[hit[:-1]]]
            wait = self.r.risky[made]
            if wait.any():
                group = np.cumsum(leading) - 1
                halt = np.bincount(group, wait) > 0
                keep = leading | ~halt[group]
                hit, made = hit[keep], made[keep]
            sym[hit] = made
            gone = np.ones(len(sym), bool)
            gone[hit + 1] = False
            at = (np.cumsum(gone) - 1)[hit]
            word, sym, seq, rank = word[gone], sym[gone], seq[gone], rank[gone]
            for left in (at, at - 1):
                left = left[(left >= 0) & (left < len(sym))]
                right = np.minimum(left + 1, len(sym) - 1)
                same = (right > left) & (seq[left] == seq[right])
                rank[left] = np.where(same, self._rank(sym[left], sym[right]), _NONE)

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each whole text; null and empty texts have none. Words are held for a few texts at a time."""
        out, start, size = [], 0, 0
        for i, t in enumerate(texts):
            n = len(t) if t else 0
            if size and size + n > SPLIT_CHARS:
                out.append(self._texts(texts[start:i]))
                start, size = i, 0
            size += n
        out.append(self._texts(texts[start:]))
        return np.concatenate(out)

    def _texts(self, texts: list[str | None]) -> np.ndarray:
        split = [self._split(t) if t else [] for t in texts]
        words = set().union(*split)
        new = list(words - self.seen.keys())
        if len(self.seen) + len(new) > CACHE_WORDS:  # start anew, within this batch's words
            self.seen, new = {}, list(words)
        counts = dict(zip(new, self.words([self._marked(w) for w in new]).tolist())) if new else {}
        short = {w: n for w, n in counts.items() if len(w) <= CACHE_CHARS}
        known = self.seen
        if len(known) + len(short) <= CACHE_WORDS:
            known.update(short)
        found = []
        for words in split:
            try:
                found.append(sum(map(known.__getitem__, words)))
            except KeyError:  # it has words that are too long to keep
                found.append(sum(counts[w] if w in counts else known[w] for w in words))
        return np.array(found, np.int64)

    @staticmethod
    def _marked(word: str) -> str:
        return word.replace(" ", SPACE) if word[:1] == " " else SPACE + word

    @staticmethod
    def _split(text: str) -> list[str]:
        """Pre-tokens: a word stands for itself behind one space; runs of spaces are spelled out."""
        text = text.replace(SPACE, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [w[1:] if w[:1] == " " and len(w) > 1 and w[1] != " " else w for w in _RUNS.findall(" " + text)]


def piece_tokens(docs: DataFrame, model_path: str, text_col: str = "text") -> Column:
    """Column with the number of tokens of ``text_col`` of ``docs``.

    As the model's own library counts: a space before the text, no begin or end
    token, unknown characters as bytes. Null and empty texts have 0 tokens. The
    vocabulary is read where the job is built and sent to the executors; its size is
    that of the model file.
    """
    spark = docs.sparkSession
    ship_package(spark)
    ranks = spark.sparkContext.broadcast(load_pieces(model_path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter(ranks.value)
        for batch in batches:
            yield pd.Series(counter.texts(batch.tolist()))

    return count(F.col(text_col).cast("string"))


def count_pieces(docs: DataFrame, model_path: str, *, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``; input columns so named are replaced."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    added = ("n_bytes", "n_tokens", "over_limit")
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in added]).alias("_row"), text.alias("_text"))
    rows = rows.select("_row.*", F.octet_length("_text").cast("long").alias("n_bytes"), piece_tokens(rows, model_path, "_text").alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)

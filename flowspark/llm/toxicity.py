"""Toxicity by a gap-weighted subsequence-kernel SVM over the words of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.session import ship_package

from .common import stored, text_key

#: Bounds of the training set: labelled rows (by a hash of their id), marked words, other words, landmarks.
TRAIN_ROWS, TRAIN_WORDS, OTHER_WORDS, LANDMARKS = 20_000, 500, 6_000, 400
#: Subsequences of 4 characters within 6, each character beyond 4 costing this factor.
GAP, SPAN, ORDER, BITS = 0.5, 6, 4, 5
#: Longer runs of letters are looked at in windows of so many, each of which begins so many after the last.
WORD_CHARS, WINDOW_STEP, CACHE_WORDS = 40, 20, 500_000
#: A training word in at least so many texts is marked if toxic texts hold it so much more often that
#: chance would hardly show it for one of all words tested: a likelihood ratio of twice the
#: log of their number, and this margin.
MARK_TEXTS, MARK_MARGIN = 3, 1.0

_ACCENTS = {"é": 26, "è": 27, "ê": 27, "ë": 27, "à": 28, "â": 28, "ä": 28, "á": 28, "ö": 28, "ü": 28, "ß": 28}
_OTHER, _START, _END = 29, 30, 31
_CUT = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")
_SPELLED = re.compile(r"(?<!\w)(?:\w[ .*_-]){3,}\w(?!\w)")
#: Positions of the later characters of a subsequence that starts at 0, and its weight.
_SHAPES = [(i, j, k, GAP ** (k - ORDER + 1)) for i in range(1, SPAN - 2) for j in range(i + 1, SPAN - 1) for k in range(j + 1, SPAN)]


def cleaned(token: str) -> str:
    """Letters of a token: characters inserted between them are left out."""
    return token if token.isalpha() else "".join(_CUT.findall(token))


def pieces(token: str) -> list[str]:
    """What the kernel sees of a token: its letters, of a long one each run of letters and each window of them all."""
    word = cleaned(token)
    if len(word) <= WORD_CHARS:
        return [word]
    runs = [r for r in _CUT.findall(token) if len(r) > 2]
    return [w[i : i + WORD_CHARS] for w in (word, *runs) for i in range(0, max(len(w) - WINDOW_STEP, 1), WINDOW_STEP)]


def _codes() -> np.ndarray:
    table = np.full(0x3000, _OTHER, np.uint8)
    for i in range(26):
        table[ord("a") + i] = i
    for c, code in _ACCENTS.items():
        table[ord(c)] = code
    return table


_CODES = _codes()


def _padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of start mark, word and end mark, in rows of one width; lengths with the marks."""
    lengths = np.array([min(len(w), WORD_CHARS) for w in words], np.int64)
    width = int(lengths.max()) + 2 + SPAN
    points = np.array(words, dtype=f"U{width - 2 - SPAN}").view(np.uint32).reshape(len(words), -1)
    out = np.full((len(words), width), 0, np.uint8)
    out[:, 1 : 1 + points.shape[1]] = np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], _OTHER)
    out[:, 0] = _START
    out[np.arange(len(words)), lengths + 1] = _END
    return out, lengths + 2


def _subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape: features (one per start) and whether they lie inside the word, and the weight."""
    codes, lengths = _padded(words)
    c = codes.astype(np.int32)
    n = c.shape[1] - SPAN
    starts = np.arange(n)
    for i, j, k, weight in _SHAPES:
        feature = ((c[:, :n] << BITS | c[:, i : i + n]) << BITS | c[:, j : j + n]) << BITS | c[:, k : k + n]
        yield feature, starts[None, :] + k < lengths[:, None], weight


def _norms(words: list[str]) -> np.ndarray:
    """Length scale of each word's features; a word shorter than a subsequence has none."""
    total = np.zeros(len(words))
    for _, inside, weight in _subsequences(words):
        total += inside.sum(1) * weight * weight
    return np.sqrt(np.maximum(total, 1e-12))


def feature_rows(words: list[str]) -> list[dict[int, float]]:
    rows: list[dict[int, float]] = [{} for _ in words]
    for feature, inside, weight in _subsequences(words):
        for r, c in zip(*np.nonzero(inside)):
            f = int(feature[r, c])
            rows[r][f] = rows[r].get(f, 0.0) + weight
    return [{f: v / n for f, v in row.items()} for row, n in zip(rows, _norms(words))]


@dataclass
class WordModel:
    """The SVM folded into one weight per subsequence: ``sum_j beta_j k(landmark_j, x) + bias``."""

    weights: np.ndarray
    bias: float

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), 4096):
            index = order[at : at + 4096]
            part = [words[i] for i in index]
            total, norm = np.zeros(len(part)), np.zeros(len(part))
            for feature, inside, weight in _subsequences(part):
                total += (self.weights[feature] * inside).sum(1) * weight
                norm += inside.sum(1) * weight * weight
            out[index] = total / np.sqrt(np.maximum(norm, 1e-12)) + self.bias
        return out


def train_words(marked: list[str], others: list[str], ridge: float = 1e-4, steps: int = 30) -> WordModel:
    """Squared-hinge SVM in the Nystroem features of landmark words.

    Landmarks are the most telling marked words and, in equal number, other words.
    Classes weigh alike. Solved by Newton steps over the active margins.
    """
    size = 1 << (BITS * ORDER)
    if not marked or not others:
        return WordModel(np.zeros(size, np.float32), -1.0)
    half = LANDMARKS // 2
    landmarks = marked[:half] + others[: LANDMARKS - min(half, len(marked))]
    rows = feature_rows(landmarks)
    used = np.array(sorted(set().union(*rows)), np.int64)
    place = np.full(size, -1, np.int32)
    place[used] = np.arange(len(used))
    basis = np.zeros((len(landmarks), len(used)), np.float32)
    for i, row in enumerate(rows):
        basis[i, place[list(row)]] = list(row.values())

    def kernel(words: list[str]) -> np.ndarray:
        k = np.zeros((len(words), len(landmarks)))
        for at in range(0, len(words), 128):
            block = np.zeros((len(words[at : at + 128]), len(used)), np.float32)
            for i, row in enumerate(feature_rows(words[at : at + 128])):
                for f, v in row.items():
                    if place[f] >= 0:
                        block[i, place[f]] = v
            k[at : at + 128] = block @ basis.T
        return k

    values, vectors = np.linalg.eigh(kernel(landmarks) + 1e-8 * np.eye(len(landmarks)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    x = np.c_[kernel(marked + others) @ root, np.ones(len(marked) + len(others))]
    y = np.r_[np.ones(len(marked)), -np.ones(len(others))]
    c = np.where(y > 0, 0.5 / len(marked), 0.5 / len(others))
    w, keep = np.zeros(x.shape[1]), np.diag(np.r_[np.full(x.shape[1] - 1, ridge), 1e-6])
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa, ca = x[active], c[active]
        new = np.linalg.solve(keep + (xa * ca[:, None]).T @ xa, xa.T @ (ca * y[active]))
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    beta = root @ w[:-1]
    weights = np.zeros(size, np.float32)
    weights[used] = beta.astype(np.float32) @ basis
    return WordModel(weights, float(w[-1]))


def _trained(spark: SparkSession, marked: list[str], others: list[str]) -> WordModel:
    """``train_words`` in a task: the driver holds the words and the weights only."""
    rows = [(i, w, i < len(marked)) for i, w in enumerate(marked + others)]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = pd.concat(list(batches)).sort_values("place")
        model = train_words(words.word[words.marked].tolist(), words.word[~words.marked].tolist())
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    words = spark.createDataFrame(rows, "place int, word string, marked boolean").coalesce(1)
    found = words.mapInPandas(fit, "weights binary, bias double").collect() if rows else []
    return WordModel(np.frombuffer(found[0].weights, np.float32), found[0].bias) if found else train_words([], [])


class Scorer:
    """Features of whole texts; margins of words are kept for the worker."""

    def __init__(self, model: WordModel):
        self.model, self.hot, self.cold = model, {}, set()

    def _learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.cold and t not in self.hot]
        if not new:
            return
        if len(self.cold) + len(new) > CACHE_WORDS:
            self.cold, self.hot = set(), {}
            new = list(tokens)
        parts = [pieces(t) for t in new]
        margins = self.model.margins([w for p in parts for w in p])
        for t, m in zip(new, np.maximum.reduceat(margins, np.cumsum([0, *map(len, parts[:-1])]))):
            if m > 0:
                self.hot[t] = float(m)
            else:
                self.cold.add(t)

    def texts(self, texts: list[str | None]) -> list[tuple[float, ...]]:
        """Per text: log of words, marked words, distinct ones and marked sentences (each 1 +), largest margin, share of marked sentences."""
        out, start, held = [], 0, 0
        for i in range(len(texts) + 1):
            n = len(texts[i] or "") if i < len(texts) else 0
            if i == len(texts) or (held and held + n > 2_000_000):
                out += self._some([(t or "").lower() for t in texts[start:i]])
                start, held = i, 0
            held += n
        return out

    def _some(self, texts: list[str]) -> list[tuple[float, ...]]:
        split = [t.split() for t in texts]
        own = [set(s) for s in split]
        for i, s in enumerate(own):
            if sum(len(t) <= 2 for t in s) >= 3:
                spelled = ["".join(_CUT.findall(m)) for m in _SPELLED.findall(texts[i])]
                split[i] += spelled
                s.update(spelled)
        self._learn(set().union(*own))
        out = []
        for text, tokens, distinct in zip(texts, split, own):
            hot = {t: self.hot[t] for t in distinct if t in self.hot}
            count = sentences = total = 0
            if hot:
                count = sum(t in hot for t in tokens)
                parts = [p for p in _SENTENCE.split(text) if p.strip()]
                total = len(parts)
                sentences = sum(any(t in hot or t.strip(".,!?") in hot for t in p.split()) for p in parts)
            top = max(hot.values(), default=0.0)
            out.append((np.log1p(len(tokens)), np.log1p(count), np.log1p(len(hot)), np.log1p(sentences), min(top, 3.0), sentences / max(1, total)))
        return out


def fit_scores(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression (last weight: bias) by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y - p) / len(x) - ridge * w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    words: WordModel
    weights: np.ndarray

    def score(self, docs: DataFrame, text_col: str = "text") -> Column:
        """Probability that the text is toxic; null and empty texts have a score too."""
        spark = docs.sparkSession
        ship_package(spark)
        model, weights = spark.sparkContext.broadcast(self.words), self.weights

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = Scorer(model.value)
            for batch in batches:
                x = np.array(scorer.texts(batch.tolist())).reshape(len(batch), -1)
                z = x @ weights[:-1] + weights[-1] if len(batch) else np.zeros(0)
                yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score(F.col(text_col).cast("string"))


def train(labelled: DataFrame, *, text_col: str = "text", label_col: str = "toxic", max_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learn from rows of text and label (0 or 1; other labels are left out).

    At most ``max_rows`` distinct texts are used, in the order of a hash of the text; a
    text with both labels counts as toxic. A word of the sentences of toxic texts is
    marked if such texts hold it far more often than others (``MARK_MARGIN``); marked and
    other words train the kernel machine. A logistic regression then weighs how many
    words and sentences it finds. Without both labels every score is the share of 1.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    label = F.col(label_col).cast("int")
    rows = labelled.filter(label.isin(0, 1)).select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), label.alias("y"))
    h = text_key(F.col("text"))
    # the keys are chosen first, so that only texts that train are moved
    keys = rows.groupBy(h[0].alias("h1"), h[1].alias("h2")).agg(F.max("y").alias("y")).orderBy("h1", "h2").limit(max_rows)
    keys = stored(keys, "toxicity-keys")
    texts = rows.select(h[0].alias("h1"), h[1].alias("h2"), "text").join(F.broadcast(keys), ["h1", "h2"])
    rows = stored(texts.groupBy("h1", "h2").agg(F.first("y").alias("y"), F.first("text").alias("text")), "toxicity-rows")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            w = [sorted({p for t in text.lower().split() for p in pieces(t)} - {""}) for text in b.text]
            yield pd.DataFrame({"word": [x for ws in w for x in ws], "y": np.repeat(b.y.to_numpy(), [len(ws) for ws in w])})

    counts = rows.repartition("h1").select("text", "y").mapInPandas(words, "word string, y int").groupBy("word").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "toxicity-words")
    total = rows.agg(F.sum("y"), F.count(F.lit(1))).first()
    toxic, clean = total[0] or 0, total[1] - (total[0] or 0)
    # likelihood ratio of a word's share of toxic texts against that of all texts
    share, r = max(toxic, 1) / max(toxic + clean, 1), F.col("p") / F.col("n")
    entropy = F.when(r < 1, (1 - r) * F.log((1 - r) / max(1 - share, 1e-9))).otherwise(0.0)
    ratio = F.when(r > share, 2 * F.col("n") * (r * F.log(r / share) + entropy)).otherwise(0.0)
    counts = counts.withColumn("z", ratio)
    is_tested = (F.col("n") >= MARK_TEXTS) & (F.length("word") >= 3)
    bound = 2 * np.log(max(1, counts.filter(is_tested).count())) + MARK_MARGIN
    marked = [x[0] for x in counts.filter(is_tested & (F.col("z") >= float(bound))).orderBy(F.desc("z"), "word").limit(TRAIN_WORDS).collect()]
    plain = counts.filter((F.col("z") < 3.0) & (F.col("n") > F.col("p")))
    others = [x[0] for x in plain.orderBy(F.desc(F.col("n") - F.col("p")), F.xxhash64("word"), "word").limit(OTHER_WORDS).collect()]
    model = _trained(spark, marked, others)
    shared = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield pd.DataFrame({"x": [list(map(float, f)) for f in scorer.texts(b.text.tolist())], "y": b.y, "h1": b.h1, "h2": b.h2})

    # sorted here: a sort by Spark would run the features again for its sample of ranges
    found = rows.mapInPandas(features, "x array<double>, y int, h1 bigint, h2 bigint").collect()
    found.sort(key=lambda r: (r.h1, r.h2))
    x = np.array([r.x for r in found]).reshape(len(found), 6)
    y = np.array([r.y for r in found], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return ToxicityModel(model, np.r_[np.zeros(6), np.log(share / (1 - share))])
    return ToxicityModel(model, fit_scores(x, y))

"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides on spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.session import ship_package

from .common import stored

KINDS = ("email", "ip", "card", "phone")
#: A span outside the base patterns needs at least this probability.
THRESHOLD = 0.9
EM_STEPS, FIT_STEPS = 50, 200

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r" ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[](?:dot|DOT)[)\]]) ?[A-Za-z0-9-]+)+")
_PLAIN_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z.-])")
_ANY = re.compile(r"[0-9@]|[(\[](?:at|AT)[)\]]")

#: Gazetteers.
TOP_DOMAINS = frozenset("com net org edu gov mil int info biz io co us uk de fr es it nl be ch at eu pl se no fi dk pt ie cz ru cn jp kr in br ca au mx".split())
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420 421 852 886 971 972".split())
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "22", "23", "24", "25", "26", "27", "35", "30", "36", "38")
CUES = {
    "email": re.compile(r"e-?mail|contact|write|reach|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|client|adresse", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|ring|handy|llam", re.I),
}
AGAINST = re.compile(r"version|token|key|hash|build|isbn|order|serial|sha|[=#\"'/_]\s*$", re.I)
CONTEXT_CHARS = 32
#: Votes a labeler can cast, as digits of a candidate's code: against, silent, for.
LABELERS = ("pattern", "gazetteer", "context", "border")


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum((2 * int(d)) // 10 + (2 * int(d)) % 10 for d in digits[-2::-2])) % 10 == 0


def _local_start(text: str, end: int, floor: int) -> int:
    while end > floor and _LOCAL.match(text, end - 1):
        end -= 1
    return end


def candidates(text: str) -> Iterator[tuple[str, int, int, int]]:
    """``(kind, start, end, pattern vote)``: 2 a base span, 1 another spelling, 0 a base pattern that failed its check."""
    last, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m and (start := _local_start(text, at, last)) < at:
            yield "email", start, m.end(), 2
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), 2 if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))) else 0
    for m in _CARD.finditer(text):
        n = m.end() - m.start()
        if n >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19:
                yield "card", m.start(), m.end(), 2 if luhn(digits) else 0
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = sum(c.isdigit() for c in m.group())
            yield "phone", m.start(), m.end(), 2 if 10 <= digits <= 15 else 0
    for m in _PLAIN_PHONE.finditer(text):
        yield "phone", m.start(), m.end(), 1
    last = 0
    for m in _AT.finditer(text):
        start = _local_start(text, m.start(), last)
        if start < m.start():
            yield "email", start, m.end(), 1
            last = m.end()


def votes(text: str, kind: str, start: int, end: int, pattern: int) -> int:
    """The labelers' votes on a candidate as one number in base 3."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        gazetteer = 2 if re.sub("[^A-Za-z].*", "", re.split(r"[.)\]]\s*", span)[-1]).lower() in TOP_DOMAINS else 0
    elif kind == "ip":
        first = int(span.split(".")[0][-4:])
        gazetteer = 2 if 1 <= first <= 254 and span != "127.0.0.1" else 0
    elif kind == "card":
        gazetteer = 2 if digits.startswith(CARD_PREFIXES) else 0
    elif span[:1] == "+":
        gazetteer = 2 if any(digits[:k] in COUNTRY_CODES for k in (1, 2, 3)) else 0
    else:
        gazetteer = 1
    before = text[max(0, start - CONTEXT_CHARS) : start]
    context = 0 if AGAINST.search(before) else 2 if CUES[kind].search(before) else 1
    tied = (start > 0 and (text[start - 1].isalnum() or text[start - 1] in "._-")) or (end < len(text) and (text[end].isalnum() or text[end] in "_-"))
    return ((pattern * 3 + gazetteer) * 3 + context) * 3 + (0 if tied else 2)


def _digits(code: int) -> list[int]:
    return [code // 27 % 3, code // 9 % 3, code // 3 % 3, code % 3]


def fit(counts: dict[tuple[str, int], int]) -> dict[tuple[str, int], float]:
    """Probability that a candidate of a kind with a vote code is personal data.

    EM (Dawid-Skene) finds each labeler's reliability for true and false candidates of
    a kind from how the labelers agree; the posteriors then are the soft labels of
    a logistic regression over the votes, shared by the kinds. Only the counts of
    distinct codes enter, at most 81 a kind.
    """
    posterior: dict[tuple[str, int], float] = {}
    for kind in KINDS:
        codes = sorted(c for k, c in counts if k == kind)
        if not codes:
            continue
        n = np.array([counts[kind, c] for c in codes], float)
        v = np.array([_digits(c) for c in codes])
        p = np.clip((v.mean(1) / 2) * 0.8 + 0.1, 0.05, 0.95)  # start from the share of votes for
        for _ in range(EM_STEPS):
            prior = (1 + (n * p).sum()) / (2 + n.sum())
            like = np.log([[1 - prior], [prior]]) * np.ones((2, len(codes)))
            for j in range(v.shape[1]):
                for y, w in ((0, n * (1 - p)), (1, n * p)):
                    # labelers are taken to be better than chance: a few imagined right votes
                    right = np.array([4.0, 0.0, 0.5]) if y == 0 else np.array([0.5, 0.0, 4.0])
                    share = right + np.bincount(v[:, j], w, 3)
                    share[1] = share[0] + share[2]  # silence says nothing
                    like[y] += np.log(share / share[1])[v[:, j]]
            p = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
        posterior |= {(kind, c): float(x) for c, x in zip(codes, p)}
    keys = sorted(posterior)
    if not keys:
        return {}

    def features(kind, code):
        one = np.zeros(len(KINDS) + len(LABELERS))
        one[KINDS.index(kind)] = 1
        one[len(KINDS) :] = np.array(_digits(code)) - 1
        return one

    x = np.array([features(*k) for k in keys])
    y = np.array([posterior[k] for k in keys])
    n = np.array([counts[k] for k in keys], float)
    n, w = n / n.sum(), np.zeros(x.shape[1])
    for _ in range(FIT_STEPS):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (n * (y - p)) - 1e-3 * w)
        w = w + move
        if np.abs(move).max() < 1e-9:
            break
    every = [(k, c) for k in KINDS for c in range(81)]
    return {k: float(1 / (1 + np.exp(-features(*k) @ w))) for k in every}


_CANDIDATES = "array<struct<kind:int,start:int,end:int,code:int>>"


def find_pii(docs: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without its text, with ``spans``: array of (kind, start, end, base, probability).

    Starts and ends are code points, end exclusive; spans go by start, then kind. All
    base spans stay. Other candidates are added where they touch no base span, no labeler
    is against them and the classifier gives them at least ``threshold``; those that
    fail a base check only help to learn the reliabilities. Null and empty texts have no spans. An input column named ``spans``
    is replaced. Texts are read once; later steps see candidates only.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf(_CANDIDATES)
    def propose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                rows = []
                if text and _ANY.search(text):
                    for kind, a, b, pattern in candidates(text):
                        rows.append({"kind": KINDS.index(kind), "start": a, "end": b, "code": votes(text, kind, a, b, pattern)})
                out.append(sorted(rows, key=lambda r: (r["start"], r["kind"], r["end"])))
            yield pd.Series(out)

    kept = [c for c in docs.columns if c not in (text_col, "spans")]
    rows = docs.select(F.struct(*kept).alias("_row"), propose(F.col(text_col).cast("string")).alias("_found"))
    rows = stored(rows, "pii-candidates")
    counts = rows.select(F.explode("_found").alias("c")).groupBy("c.kind", "c.code").count().collect()
    scores = fit({(KINDS[r["kind"]], r["code"]): r["count"] for r in counts})
    table = F.lit([scores.get((k, c), 0.0) if min(_digits(c)) > 0 or c >= 54 else 0.0 for k in KINDS for c in range(81)])

    base = F.filter("_found", lambda c: c["code"] >= 54)
    rows = rows.withColumn("_base", base)
    probability = lambda c: F.get(table, c["kind"] * 81 + c["code"])
    touches = lambda c: F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    chosen = F.filter("_found", lambda c: (c["code"] >= 54) | ((probability(c) >= threshold) & ~touches(c)))
    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(
        chosen,
        lambda c: F.struct(
            F.get(names, c["kind"]).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), (c["code"] >= 54).alias("base"), probability(c).alias("probability")
        ),
    )
    return rows.select("_row.*", spans.alias("spans"))

"""The source divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowspark.llm import divergence
from flowspark.llm.divergence import divergences, share, terms

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    langs = defaultdict(lambda: defaultdict(Counter))
    df = defaultdict(Counter)
    for _, text, lang, source in rows:
        words = TERM.findall((text or "").translate(UPPER))
        langs[lang or ""][source or ""].update(words)
        df[lang or ""].update(set(words))
    out = set()
    for lang, groups in langs.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        of = {s: p(c) for s, c in groups.items()}
        whole = p(sum(groups.values(), Counter()))
        for s, mine in of.items():
            pairs = [(sum(abs(mine[t] - other[t]) for t in kept), x) for x, other in of.items() if x != s]
            over = [(mine[t] - whole[t], t) for t in kept if groups[s][t] > 0 and mine[t] > whole[t]]
            for part, found in (("pair", pairs), ("term", over)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, i, v, r) for r, (v, i) in enumerate(found, 1) if part == "pair" or r <= top}
    return out


def test_terms_part_at_everything_but_letters():
    assert terms("Don't STOP_ÄÖ naïve x日本 9a") == [w.encode() for w in ("don", "t", "stop", "ÄÖ", "naïve x日本", "a")]


def test_equals_plain_counting(spark):
    rng = random.Random(3)
    words = ["the", "The", "ß", "日本", "a", "zz", "é", "x1y", "q" * 5000] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(400):
        source = rng.choice(["hot"] * 5 + ["b", "c", None, ""])
        text = " ".join(rng.choices(words, k=rng.randint(0, 30))) if rng.random() < 0.9 else rng.choice([None, "", "!!"])
        rows.append((i % 300, text, rng.choice(["en", "de", None]), source))
    rows += [(1, "lonely", "xx", "one"), (2, "too rare", "yy", "a"), (None, None, "yy", "b")] + rows[:40]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("df", "term", "counts", "rank", "part", "item", "value"):
        df = df.withColumn(c, F.lit(c))
    got = [tuple(r) for r in divergences(df, least_docs=10, top=5).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, 10, 5)


def test_empty_table(spark):
    assert divergences(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spilled_stripes_merge_to_the_same(monkeypatch):
    rng = random.Random(5)
    docs = [("en", rng.choice("abc"), " ".join(rng.choices("uvwxyz", k=8))) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict(dict(zip(("lang", "source", "text"), zip(*docs))))

    def merged(size):
        parts = pa.Table.from_batches(divergence._fold(iter([batch]))).sort_by([("term", "ascending"), ("lang", "ascending")])
        cut = parts.combine_chunks().to_batches(max_chunksize=size)
        whole = pa.Table.from_batches(divergence._merge(iter(cut), 1)).to_pylist()
        return len(parts), {r["term"]: (r["df"], dict(zip(r["sources"], r["counts"]))) for r in whole}

    few, want = merged(1000)
    monkeypatch.setattr(divergence, "SPILL_CELLS", 7)
    for size in (1, 3, 1000):
        many, got = merged(size)
        assert got == want and len(got) == 7 and many > 10 * few


def test_shares_beyond_64_bits():
    counts, total, kept = np.array([[0, 3, 10**15]]), np.array([10**15 + 3]), 3
    assert share(counts, total, kept).tolist() == [[1 + 10**9 * (c + 5) // (10**15 + 18) for c in (0, 3, 10**15)]]

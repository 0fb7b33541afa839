"""Each stage of the pipeline on what the one before kept, against plain Python."""

import re

import corpus_pipeline as cp
from flowspark.llm.common import stored


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        seen[name] = docs
        if name != cp.STAGES[-1][0]:
            assert docs.columns == columns
    raw = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    clean = {r.doc_id: r.text for r in seen["toxicity"].collect()}
    assert 0 < len(clean) < len(raw)

    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for d in sorted(clean):
        for line in clean[d].split("\n"):
            first.setdefault(key(line), d)
    lines = {d: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == d) for d, t in clean.items()}
    got = seen["line_dedup"].collect()
    assert {r.doc_id: r.text for r in got} == lines
    assert all(r.n_chars == len(r.text) for r in got if r.text != clean[r.doc_id])

    from tests.llm.test_operators import brute_components

    components = brute_components(list(lines.items()), 80, 100)
    unlike = {d: t for d, t in lines.items() if components[d][1] == d}
    assert {r.doc_id: r.text for r in seen["near_dedup"].collect()} == unlike

    fold = lambda t: re.sub(r"[\W_]+", " ", t.lower()).strip()
    items = [fold(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {d for d, t in unlike.items() if any(len(i) >= 40 and f" {i} " in f" {fold(t)} " for i in items)}
    kept = {r.doc_id: r.text for r in seen["decontamination"].collect()}
    assert leaked.isdisjoint(kept) and len(unlike) - len(kept) == len(leaked)

    import public_tokenizers
    import tiktoken

    from flowspark.llm.byte_bpe import ByteRanks

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ByteRanks.read(cp.RANKS).tokens, special_tokens={})
    last = {r.doc_id: list(r.ids) for r in seen["byte_bpe"].collect()}
    assert last == {d: enc.encode_ordinary(t) for d, t in kept.items()}


def test_stages_on_odd_tables(spark, sf_dir):
    from pyspark.sql import functions as F

    plain = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = ("_score", "_passages", "_gone", "_row", "n_lines", "n_dropped", "kept_text", "component_id", "kept", "ids", "found", "words")
    long = " ".join(f"w{i}" for i in range(60_000)) + " "
    rows = [(None, None), (-1, None), (-2, ""), (-3, " \n \t"), (-4, long + "once"), (-5, long + "more"), (None, "no id but a line"), (-6, "twice the same row"), (-6, "twice the same row")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "doc_id", "text", *[F.lit(None).cast(plain.schema[c].dataType).alias(c) for c in ("lang", "source", "n_chars")]
    )
    docs = plain.limit(60).unionByName(odd)
    for n in names:
        docs = docs.withColumn(n, F.lit(f"mine {n}"))
    docs = stored(docs, "test-odd")
    for name, stage in cp.STAGES:
        got = stored(stage(spark, docs, sf_dir), "test-stage")
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.collect() == [] and empty.schema == got.schema
        if name == cp.STAGES[-1][0]:
            assert {(r.doc_id, r.n_tokens) for r in got.collect()} >= {(None, 0), (-1, 0), (-2, 0)}
            assert got.count() == docs.count()
            break
        assert got.columns == docs.columns
        for r in got.collect():
            assert all(r[n] == f"mine {n}" for n in names)
        ids = [r.doc_id for r in got.collect() if r.doc_id is None or r.doc_id < 0]
        assert ids.count(None) == 2 and ids.count(-1) == ids.count(-2) == ids.count(-3) == 1 and ids.count(-6) == 2
        if name == "near_dedup":
            assert -5 in ids and -4 not in ids
        docs = got

"""The registered queries against their SQL, and the digests against the libraries."""

import hashlib
import re
import zlib
from collections import Counter

import pytest

from flowspark.llm import QUERIES, SQL
from tests.compare import difference


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_piece_counts(spark, sf_dir, texts):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = QUERIES["op2_piece_counts"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(sp.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_byte_bpe(spark, sf_dir, texts):
    import public_tokenizers
    import tiktoken

    from flowspark.llm.bpe_queries import RANKS
    from flowspark.llm.byte_bpe import ByteRanks

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ByteRanks.read(RANKS).tokens, special_tokens={})
    rows = QUERIES["op8_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_shards(spark, sf_dir, texts):
    rows = QUERIES["op3_shards"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    size, slots, home = Counter(), {}, {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        size[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        assert home.setdefault(texts[r.doc_id], r.shard) == r.shard
    groups = Counter()
    for t in texts.values():
        groups[t] += len(t.encode()) + 1
    assert set(size) <= set(range(16))
    assert max(size.values()) - min(size[s] for s in range(16)) <= max(groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pii(spark, sf_dir, texts):
    from flowspark.llm.pii import KINDS
    from tests.llm.test_pii import base_spans

    for r in QUERIES["op7_pii"](spark, sf_dir).collect():
        spans = base_spans(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[1] == i for s in spans) for i in range(4)]
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op4_toxicity"](spark, sf_dir).toPandas()
    assert len(rows) == 10_000 and rows.score.between(0, 1).all()
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.5)).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    x = rows[rows.held_out].merge(labels, on="doc_id")
    rank, n = x.score.rank(), x.toxic.sum()
    auc = (rank[x.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(x) - n))
    assert auc > 0.95 and (x.predicted == x.toxic).mean() > 0.97


def test_decontaminate(spark, sf_dir, texts):
    from flowspark.llm.decontaminate import MIN_CHARS

    fold = lambda t: re.sub(r"[\W_]+", " ", t.lower()).strip()
    items = {r.item_id: fold(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    for r in QUERIES["op1_decontaminate"](spark, sf_dir).collect():
        held = {i for i, t in items.items() if len(t) >= MIN_CHARS and f" {t} " in f" {fold(texts[r.doc_id])} "}
        assert held <= set(r["items"]) and r.contaminated == bool(r["items"])

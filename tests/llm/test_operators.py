"""Small cases of each operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flowspark.llm.bpe_queries import RANKS
from flowspark.llm.byte_bpe import ByteRanks, encode_bytes, heap_encode
from flowspark.llm.common import among
from flowspark.llm.decontaminate import ERROR_RATE, MIN_CHARS, REGION, REGION_STEP, Finder, Index, decontaminate, folded
from flowspark.llm.line_dedup import dedup_lines
from flowspark.llm.near_dup import connected, linked_pairs, near_duplicates
from flowspark.llm.piece_count import PieceCounter, count_pieces, load_pieces
from flowspark.llm.pivot_topk import top_k
from flowspark.llm.sharding import BinTree, pack, pack_into, shard_by_bytes
from flowspark.llm.toxicity import Scorer, cleaned, train
from flowspark.llm.url_filter import Rule, judge, segmented

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# token counts


def test_pieces_of_random_texts():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter, rng = PieceCounter(load_pieces(PIECES)), random.Random(1)
    parts = list("ab  \n\t.<>s/0日語éß😀▁ 　the") + ["<s>", "</s>", "the ", "   ", "ing", "<0x0A>", "\x00", "aaaa", "----"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "a" * 50_000, " " * 3000, "ab" * 20_000, "日本語" * 3000] + ["".join(rng.choice("abe=-. ") for _ in range(2000)) for _ in range(20)]
    assert counter.texts(texts).tolist() == [len(x) for x in sp.encode(texts)]


def test_pieces_of_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x")]
    got = count_pieces(docs(rows).withColumn("n_tokens", F.lit("mine")), PIECES, limit=1).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [(0, 1, 1, False), (1, 0, 0, False), (2, 0, 0, False), (3, 3, 2, True), (3, 3, 2, True)]
    assert count_pieces(docs([]), PIECES).collect() == []


# byte-level BPE


def test_bpe_round_trip_of_odd_texts(docs):
    import tiktoken

    ranks = ByteRanks.read(RANKS).tokens
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    parts = list("ab's \n\t\x0b\x1c\x85.1²½٣日本éß😀 　​ ñ") + ["the ", "'ll", "   ", "\r\n", "<|endoftext|>", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += ["a" * 5000, "ab" * 1000 + " " * 1000 + "x", "日本語" * 200, "", None]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    got = encode_bytes(docs(rows).withColumn("ids", F.lit(1)), RANKS, public_tokenizers.PATTERN, dictionary_words=50).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == enc.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    from flowspark.llm.byte_bpe import Codec

    back = docs([(0, "x")]).select(Codec(ByteRanks.read(RANKS), "x").decode(F.array(*[F.lit(i) for i in enc.encode_ordinary("naïve 日本")])).alias("b"))
    assert bytes(back.first().b).decode() == "naïve 日本"
    assert heap_encode(b"aaaa bb", ranks) == enc.encode_single_piece("aaaa bb") if hasattr(enc, "encode_single_piece") else True
    assert encode_bytes(docs([]), RANKS, public_tokenizers.PATTERN).collect() == []


def test_bpe_rank_map_is_in_no_plan(docs):
    from flowspark.llm.byte_bpe import Codec

    codec = Codec(ByteRanks.read(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(3)
    texts = ["lower", "日本語", "x", "x", *("".join(rng.choice("etaoinsé ") for _ in range(rng.randint(2, 30))) for _ in range(300))]
    folded = codec.folded(docs(list(enumerate(texts))).select(F.col("text").alias("w")))
    assert len(folded._jdf.queryExecution().toString()) < 100_000  # what the driver keeps for each query
    got = folded.collect()
    assert sorted(r.w for r in got) == sorted(texts)
    assert all(list(r.ids) == heap_encode(r.w.encode(), codec.ranks.tokens) for r in got)


# line deduplication


def test_lines_keep_their_first_document(docs):
    rows = [(2, "A shared line\nown\n\nA shared line"), (1, "  a SHARED line\t\nb"), (None, "a shared line"), (3, None), (4, ""), (5, "short\nshort"), (6, "short"), (7, "twice here..\ntwice here.."), (7, "twice here..\ntwice here..")]
    got = dedup_lines(docs(rows).withColumn("n_lines", F.lit("mine"))).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text): (r.kept_text, r.n_lines, r.n_dropped) for r in got}
    assert by[2, rows[0][1]] == ("own\n", 4, 2)
    assert by[1, rows[1][1]] == (rows[1][1], 2, 0)
    assert by[None, "a shared line"] == ("", 1, 1)
    assert by[3, None] == ("", 1, 0) and by[4, ""] == ("", 1, 0)
    assert by[5, "short\nshort"] == ("short\nshort", 2, 0)
    assert by[7, rows[7][1]] == (rows[7][1], 2, 0)
    assert dedup_lines(docs([])).collect() == []


def test_lines_of_three_documents(docs):
    rows = [(i, "a line of many documents\nanother line of two" if i < 2 else "a line of many documents") for i in range(3)]
    got = {r.doc_id: r.kept_text for r in dedup_lines(docs(rows), min_docs=3).collect()}
    assert got == {0: rows[0][1], 1: "another line of two", 2: ""}


# sharding


def test_tree_gives_the_tightest_bin():
    rng, tree, plain = random.Random(4), BinTree(), []
    for step in range(3000):
        if rng.random() < 0.6:
            key = (rng.randint(0, 50), step)
            tree.add(key)
            plain.append(key)
        else:
            room = rng.randint(0, 50)
            fits = [k for k in plain if k[0] >= room]
            want = min(fits) if fits else None
            assert tree.take_tightest(room) == want
            if want:
                plain.remove(want)


def test_pack_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        bins, where = [], []
        for s in sizes:
            fits = [(room, b) for b, room in enumerate(bins) if room >= s]
            b = min(fits)[1] if fits else len(bins)
            if not fits:
                bins.append(50)
            bins[b] -= s
            where.append((s, b))
        placed, n = pack(sorted(Counter(sizes).items(), reverse=True), 50)
        got = [(s, b) for s, runs in placed.items() for (end, b), (start, _) in zip(runs, [(0, 0), *runs]) for _ in range(end - start)]
        assert n == len(bins) and Counter(got) == Counter(where)


def test_shards_of_odd_tables(docs):
    rows = [(i, "x" * (i % 50)) for i in range(500)] + [(1000, None), (1001, ""), (1001, ""), (None, "y")] + [(2000 + i, "copy " * 400) for i in range(300)]
    got = shard_by_bytes(docs(rows).withColumn("slot", F.lit("mine")), 4).collect()
    assert len(got) == len(rows)
    size = Counter()
    for r in got:
        size[r.shard] += r["size"]
    assert sum(size.values()) == sum(len((t or "").encode()) + 1 for _, t in rows)
    assert len({r.shard for r in got if r.doc_id is not None and r.doc_id >= 2000}) == 1
    small = [size[s] for s in range(4) if size[s] < 300 * 2001]
    assert max(small) - min(small) <= 500
    assert shard_by_bytes(docs([]), 4).collect() == []
    assert sum(end - 0 for end, _ in pack_into([(5, 1)], 4)[5]) == 1


# top k


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(6)
    vectors = [[float(x) for x in v] for v in rng.integers(-3, 4, (400, 6)) / 8]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000, None), (1001, [1.0, None] + [0.0] * 4), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (None, vectors[0]), (5, vectors[5]), (1004, [1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in top_k(table, F.col("vec_id") % 10 == 0, 5).collect())
    ints = np.floor(256 * np.array([*vectors, [1.0] + [0.0] * 5])).astype(np.int64)  # the short one counts as filled with zeros
    ids = [*range(400), 1004]
    want = []
    for q in range(0, 400, 10):
        scores = sorted((-int(s), i) for i, s in zip(ids, ints @ ints[q]) if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == sorted(want)
    assert top_k(table.limit(0), F.col("vec_id") % 10 == 0, 5).collect() == []
    few = top_k(spark.createDataFrame(rows[:3], table.schema), F.col("vec_id") == 0, 5).collect()
    assert len(few) == 2


def test_top_k_of_large_and_unequal_vectors(spark):
    from flowspark.llm.pivot_topk import whole

    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(120)]
    rows += [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([6, 7, 9, 15]) for _ in range(3)]) for i in range(200, 230)]
    rows += [(300, [9e6, 1.0]), (310, [4.2e6, 4.2e6]), (320, [1.0] * 5), (330, [1e300, -1e300, 0.0]), (340, [0.5]), (341, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in top_k(table, F.col("vec_id") % 10 == 0, 4).collect())
    ints = {i: [whole(x) for x in v] for i, v in rows if v}
    want = []
    for q in (i for i in ints if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:4]
        want += [(q, k + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for k, (s, i) in enumerate(scores)]
    assert got == sorted(want) and any(r[3] is None for r in got) and any(abs(r[3] or 0) > 1 << 40 for r in got)


# url filter


def test_urls(spark):
    rules = [Rule("allow", "com/"), Rule("block", "bad.com/x/")]
    urls = ["http://A.BAD.com/x/1", "http://bad.com/y", None, "no scheme", "ftp://notbad.com", "http://xbad.com/x/1", "http://cheap-pills.org/x/9", "http://goodnews.org/y?a=/x/", "http://cheappills.org/x", ""]
    train_rows = [f"http://bad.com/x/cheap-pills-{i}" for i in range(20)] + [f"http://good.com/good-news-{i}" for i in range(20)]
    pages = spark.createDataFrame(list(enumerate(urls + train_rows)) + [(0, urls[0])], "page_id int, url string").withColumn("host", F.lit(1))
    got = {}
    for r in judge(pages, rules).collect():
        got[r.page_id] = r
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("a.bad.com", "/x/1", "bad.com/x/", "block")
    assert (got[1].rule, got[1].verdict) == ("com/", "allow")
    assert [(got[i].host, got[i].path, got[i].rule) for i in (2, 3, 9)] == [("", "", None)] * 3
    assert (got[4].host, got[4].path, got[4].rule) == ("notbad.com", "", None)
    assert got[5].rule == "com/"
    assert got[6].verdict == "block" and got[7].verdict == "allow" and got[8].verdict == "block"
    assert judge(pages.limit(0), rules).collect() == []


def test_frequent_concatenated_names_are_split(spark):
    ruled = [f"http://bad.com/x/cheap-pills-{i}" for i in range(20)] + [f"http://good.com/good-news-{i}" for i in range(60)]
    hot = [f"http://cheappills.org/{i}" for i in range(500)] + [f"http://goodnews.org/{i}" for i in range(500)] + ["http://cheappillsgoodnews.org/"]
    pages = spark.createDataFrame([(i, u, "Cheappills today" if "cheappills.org" in u else "") for i, u in enumerate(ruled + hot)], "page_id int, url string, title string")
    got = {(r.host, r.verdict) for r in judge(pages, [Rule("allow", "com/"), Rule("block", "bad.com/x/")], word_text=F.col("title")).collect()}
    assert {("cheappills.org", "block"), ("goodnews.org", "allow")} <= got
    assert ("cheappills.org", "allow") not in got and ("goodnews.org", "block") not in got
    evidence = spark.createDataFrame([("cheap", 1, 1), ("pills", 0, 1), ("cheappills", 0, 1), ("at", 50, 0)], "word string, n long, bare long")
    names = spark.createDataFrame([("cheappills",), ("cheap",), ("zzz",)], "name string")
    assert {r["name"]: r.words for r in segmented(names, evidence).collect()} == {"cheappills": ["cheap", "pills"], "cheap": ["cheap"], "zzz": ["zzz"]}


def test_segmentation_equals_all_splits():
    import itertools
    import math

    from flowspark.llm.url_filter import _viterbi

    rng, letter = random.Random(4), math.log(10)
    for _ in range(300):
        name = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        n = len(name)
        log = {(a, b): -rng.random() * 12 for a in range(n) for b in range(a + 2, n + 1) if rng.random() < 0.4}
        unknown = -rng.random() * 6
        cost = lambda a, b: max(log.get((a, b), -math.inf), unknown - (b - a) * letter)
        cuts = (
            [0, *c, n] for k in range(n) for c in itertools.combinations(range(1, n), k)
        )
        top = max(sum(cost(a, b) for a, b in zip(c, c[1:])) for c in cuts)
        words = _viterbi(name, log, unknown)
        ends = list(itertools.accumulate(map(len, words), initial=0))
        assert "".join(words) == name and abs(sum(cost(a, b) for a, b in zip(ends, ends[1:])) - top) < 1e-9


def test_joined_words_are_found_and_single_ones_left(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(150)})
    counts = [(w, rng.randint(2, 50), 1) for w in words] + [("n", 500, 1), ("et", 400, 1), ("net", 0, 1)]
    joined = {"".join(p): list(p) for p in (rng.sample(words, rng.choice([2, 3])) for _ in range(200))}
    long = "".join(words[:30])
    names = spark.createDataFrame([(n,) for n in [*joined, *words, "net", "x" * 3000, long]], "name string")
    got = {r["name"]: r.words for r in segmented(names, spark.createDataFrame(counts, "word string, n long, bare long")).collect()}
    assert sum(got[n] == p for n, p in joined.items()) >= 0.9 * len(joined)  # some have other splits as likely
    assert sum(got[w] == [w] for w in words) >= 0.95 * len(words)
    assert got["net"] == ["net"] and got["x" * 3000] == ["x" * 3000] and "".join(got[long]) == long and len(got[long]) > 20


# near duplicates


def brute_components(rows, num, den):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for i, t in rows}
    sets = {i: ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())) for i, w in words.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if den * both >= num * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((find(x), find(y)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_equal_brute_force(docs):
    rng, rows = random.Random(7), []
    for g in range(25):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 8, 60, 200]))]
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"n{rng.randint(0, 9999)}"
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    rows += [(9000, None), (9001, ""), (9002, " \n "), (9003, "a b"), (9004, "A  b")]
    for num in (80, 85):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs(rows), num=num).collect()}
        assert got == brute_components(rows, num, 100)


def test_large_region_is_compared_whole(docs):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(700):  # more than a block
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(rows), num=85).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 85, 100).items()}


def test_crowded_regions_of_several_groups(docs, monkeypatch):
    from flowspark.llm import near_dup

    monkeypatch.setattr(near_dup, "BLOCK", 8)
    seen = []
    monkeypatch.setattr(near_dup, "_apart", lambda *a, f=near_dup._apart: seen.append(f(*a)) or seen[-1])
    rng, common, rows = random.Random(12), [f"c{i}" for i in range(150)], []
    for g in range(12):  # the groups share most words, so that they meet in crowded regions, but are no copies of each other
        base = [*common, *(f"g{g}x{i}" for i in range(40))]
        for _ in range(rng.choice([1, 3, 30])):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"n{rng.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(rows), num=85, sparse=(2, 4)).collect()}
    want = {i: c for i, (_, c) in brute_components(rows, 85, 100).items()}
    assert got == want and len(set(want.values())) > 5
    assert seen[0] is not None and seen[0].count() > 0  # what blocks and their first members left open


def test_recall_of_pairs_at_the_bound(docs):
    rng, rows, pairs = random.Random(13), [], 0
    for g in range(250):
        w = [f"g{g}w{i}" for i in range(104)]  # 100 shingles; two words of the ends' sides changed leave 0.85 to 0.9 in common
        other = list(w)
        for at in rng.sample(range(10, 94), 1) + [0, 103][: rng.randint(1, 2)]:
            other[at] = f"n{rng.randint(0, 10**6)}"
        rows += [(2 * g, " ".join(w)), (2 * g + 1, " ".join(other))]
    want = {i: c for i, (_, c) in brute_components(rows, 85, 100).items()}
    pairs = sum(want[2 * g + 1] == 2 * g for g in range(250))
    got = {r.doc_id: r.component_id for r in near_duplicates(docs(rows), num=85).collect()}
    found = sum(got[2 * g + 1] == want[2 * g + 1] == 2 * g for g in range(250))
    assert pairs > 100 and found >= 0.99 * pairs and all(got[i] in (i, want[i]) for i in got)


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_rows_among_ids_are_told_before_an_exchange(docs, n):
    rows = [(i * 7 - 90_000, "x") for i in range(30_000)] + [(None, "x")]
    ids = docs([(i * 70 - 90_000, None) for i in range(n)] + [(None, None)]).select("doc_id")
    wanted = {i * 70 - 90_000 for i in range(n)}
    found = among(docs(rows), "doc_id", ids.withColumnRenamed("doc_id", "rid"))
    assert "Exchange hashpartitioning(doc_id" not in found._jdf.queryExecution().executedPlan().toString()
    got = [r.doc_id for r in found.collect()]
    assert wanted <= set(got) and len(got) == len(set(got)) and len(got) <= n + 30_000 / 16 * 1.3


def test_near_duplicates_of_odd_rows(docs):
    rows = [(None, "one two three four five six"), (3, "one two three four five six"), (3, "one two three four five six"), (2, "x " * 30_000), (None, "all alone in this world here")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs(rows).withColumn("kept", F.lit(1))).collect()), key=str)
    assert got == sorted([(None, 3, False), (3, 3, True), (3, 3, True), (2, 2, True), (None, None, True)], key=str)
    assert near_duplicates(docs([])).collect() == []


def test_linked_pairs_by_matrix():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    a, b = linked_pairs(sets, 50, 100)
    want = {(i, j) for i in range(30) for j in range(i + 1, 30) if 100 * len(set(sets[i]) & set(sets[j])) >= 50 * len(set(sets[i]) | set(sets[j]))}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_connected_along_a_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a bigint, b bigint"), "chain").collect()}
    assert {got[i] for i in range(1, 61)} == {0} and got[101] == 100


# decontamination


def test_passages_with_edits(spark, docs):
    item = "The quick brown fox jumps over the lazy dog while seven wizards box quietly in the moonlit garden of the old castle"
    edited = item.replace("lazy", "lzy").replace("seven", "sevven").upper().replace(" ", ",  ")
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (None, item + " x"), (4, item)], "item_id bigint, text string")
    rows = [(1, f"Before. {item}! After."), (2, f"x {edited} y"), (3, None), (4, ""), (5, item[: len(item) // 2]), (6, f"{item} and again {item}"), (None, "nothing here " * 2000), (1, f"Before. {item}! After.")]
    got = {}
    for r in decontaminate(docs(rows).withColumn("passages", F.lit(1)), bench).collect():
        got[r.doc_id] = r
    assert got[1].contaminated and got[1].passages[0].item_id == 1 and got[1].passages[0].edits == 0
    assert rows[0][1][got[1].passages[0].start : got[1].passages[0].end] == item
    assert got[1].clean_text == "Before.  ! After."
    assert got[2].contaminated and 0 < got[2].passages[0].edits <= len(item) * 0.1
    assert got[6].clean_text.split() == ["and", "again"]
    assert not any(got[i].contaminated for i in (3, 4, 5, None)) and got[3].clean_text is None and got[4].clean_text == ""
    assert len(item) >= MIN_CHARS
    assert decontaminate(docs([]), bench).collect() == []
    assert not any(r.contaminated for r in decontaminate(docs(rows), bench.limit(0)).collect())


def plain_distance(item, text):
    """Fewest edits that turn the item into some stretch of the text."""
    cost = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, cost[0] = cost[0], i
        for j, b in enumerate(text, 1):
            last, cost[j] = cost[j], min(last + (a != b), cost[j] + 1, cost[j - 1] + 1)
    return cost[-1] if not text else min(cost)


def test_copies_at_the_full_edit_budget():
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = lambda n: "".join(rng.choice(letters) for _ in range(n))
    for n in (40, 41, 49, 50, 60, 80, 119, 120, 200, 400):
        item, budget = made(n), int(n * ERROR_RATE)
        finder = Finder(Index.build([(1, folded(item)[0])]))
        for kind in ("spread", "random", "mixed"):
            for edits in (budget, budget + 2):
                copy = list(item)
                places = [int((i + 0.5) * n / edits) for i in range(edits)] if kind == "spread" else rng.sample(range(n), edits)
                for at in sorted(places, reverse=True):
                    how = rng.choice("sid") if kind == "mixed" else "s"
                    copy[at : at + 1] = {"s": [rng.choice(letters.replace(item[at], ""))], "i": [item[at], rng.choice(letters)], "d": []}[how]
                text = f"{made(300)} {''.join(copy)} {made(300)}"
                want = plain_distance(item, text)
                found = finder.find(text)
                if want > budget and n > REGION:  # a region may still be within its own budget
                    ends = {*range(0, n - REGION, REGION_STEP), n - REGION}
                    assert bool(found) == any(plain_distance(item[a : a + REGION], text) <= int(REGION * ERROR_RATE) for a in ends)
                    continue
                assert [f[3] for f in found] == ([want] if want <= budget else []), (n, kind, edits)
                assert edits > budget or found


def test_regions_and_short_items():
    rng = random.Random(5)
    words = [f"{''.join(rng.choice('abcdefgh') for _ in range(5))}{i}" for i in range(120)]
    item, short = " ".join(words), "two plus two is four"
    finder = Finder(Index.build([(7, folded(item)[0]), (8, folded(short)[0])]))
    for a in range(0, 70, 7):  # any stretch that is long enough, wherever in the item it begins
        quote = " ".join(words[a : a + 54])
        assert len(quote) >= REGION + REGION_STEP
        (found,) = finder.find(f"before {quote} after")
        slack = int(REGION * ERROR_RATE)  # a region that reaches beyond the quote may still be within its budget
        assert found[0] == 7 and found[3] <= slack and 7 - slack <= found[1] and found[2] <= 7 + len(quote) + slack
        assert found[2] - found[1] >= len(quote) - 2 * REGION_STEP
    assert finder.find(" ".join(words[3:20])) == []
    (found,) = finder.find("x " + item + " y")  # the whole item is one find, not its regions
    assert found[1:] == (2, 2 + len(item), 0)
    text = "So: Two plus  TWO, is four! But not twotwo plus two is fourteen."
    (found,) = finder.find(text)
    assert found[0] == 8 and text[found[1] : found[2]] == "Two plus  TWO, is four"
    assert finder.find("two plus two is forty") == [] and finder.find("untwo plus two is four") == []


# toxicity


@pytest.fixture(scope="module")
def toxic_model(spark):
    rng = random.Random(10)
    words = ["".join(rng.choice("aeiounrtsl") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(600):
        text = [rng.choice(words) for _ in range(40)]
        if i % 6 == 0:
            text[rng.randrange(40)] = rng.choice(["blockhead", "dumpkopf"])
        rows.append((" ".join(text) + ".", int(i % 6 == 0)))
    rows += [(None, 0), ("", 0), ("label", None), ("other", 7), ("same text", 0), ("same text", 1)]
    return train(spark.createDataFrame(rows, "text string, toxic int"))


def test_gapped_insults(spark, docs, toxic_model):
    rows = [(1, "you are a blockhead today."), (2, "you are a block-head today."), (3, "what a bloxckhead he is"), (4, "b l o c k h e a d"), (5, "a tree on a stone"), (6, None), (7, ""), (8, "stone " * 40_000), (9, "b.l.o.c.k.h.e.a.d!")]
    table = docs(rows)
    got = {r.doc_id: r.s for r in table.select("doc_id", toxic_model.score(table).alias("s")).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert all(got[i] >= 0.5 for i in (1, 2, 3, 4, 9)), got
    assert all(got[i] < 0.5 for i in (5, 6, 7, 8)), got


def test_every_letter_of_long_tokens_is_looked_at():
    from flowspark.llm.toxicity import WINDOW_STEP, WORD_CHARS, pieces

    word = "".join(chr(97 + i % 26) for i in range(500))
    parts = pieces(word)
    assert all(len(p) <= WORD_CHARS for p in parts) and pieces("short") == ["short"] and pieces("s.h-o*rt") == ["short"]
    assert all(any(word[i : i + WINDOW_STEP] in p for p in parts) for i in range(len(word) - WINDOW_STEP + 1))
    assert "insult" in pieces("-".join(["harmless"] * 20 + ["insult"]))


def test_scores_without_anything_to_learn(spark, docs):
    model = train(spark.createDataFrame([], "text string, toxic int"))
    table = docs([(1, "a"), (2, None)])
    assert [r.s for r in table.select(model.score(table).alias("s")).collect()] == [0.5, 0.5]
    assert cleaned("i.d-iot!") == "idiot"
    assert len(Scorer(model.words).texts([])) == 0

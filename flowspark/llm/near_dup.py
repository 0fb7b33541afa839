"""Near-duplicate documents through an LSH forest: sorted orders of MinHash signatures, searched to the depth each region calls for."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.session import ship_package

from .common import among, global_rank, stored
from .shingles import class_key, normal, shingle_sets, signatures

#: 12 orders of 64 values: a pair of similarity 0.85 shares the first three values of at
#: least one order but for one case in 90,000.
HASHES, TREES = 64, 12
#: A region of documents that share their first value in an order is compared whole up to so many
#: members; a more crowded one is parted by the second value, then by the third.
SPARSE = (16, 64)
#: Members that are compared at a time; a region of three values that is larger is cut into blocks along its order.
BLOCK = 512
#: A pair goes on to the full sets if so many standard errors above its signatures' share reach the bound.
ERRORS = 5.0


def connected(links: DataFrame, name: str) -> DataFrame:
    """``node, root``: the smallest node reachable over ``links`` (``a``, ``b``), for every node in them.

    Alternates large-star and small-star steps (each links a node's neighbours to the
    smallest of them) until nothing changes; every step is stored.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    while True:
        # large star: neighbours above a node go to the least in reach
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(least, both["u"] == least["c"]).filter("v > c").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), name)
        # small star: a node and its lesser neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        small = large.join(least, large["u"] == least["c"]).select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
        small = stored(small.filter("u <> v").distinct(), name)
        total = "sum(cast(xxhash64(u, v) as decimal(38,0))) as h"
        state = small.selectExpr("count(*) as n", total).first()
        if state == edges.selectExpr("count(*) as n", total).first():
            break
        edges = small
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _alike(sig: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), 1 << 16):
        s = slice(at, at + (1 << 16))
        keep[s] = (sig[a[s]] == sig[b[s]]).sum(1) >= least
    return keep


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member reachable, of each of n, over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked_pairs(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``sets`` with den * intersection >= num * union, exactly."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    if n <= 8:
        a, b = np.triu_indices(n, 1)
        common = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    else:
        shared = np.zeros((n, n), np.int64)
        values, column = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(n), sizes)
        count = np.bincount(column, minlength=len(values))
        use = np.cumsum(count > 1) - 1  # a shingle of one set is in no intersection
        inside = count[column] > 1
        owner, column = owner[inside], use[column[inside]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        width = 4096
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            lo, hi = np.searchsorted(column, [at, at + width])
            part = np.zeros((n, width), np.float32)
            part[owner[lo:hi], column[lo:hi] - at] = 1
            shared += np.rint(part @ part.T).astype(np.int64)
        a, b = np.triu_indices(n, 1)
        common = shared[a, b]
    union = sizes[a] + sizes[b] - common
    ok = den * common >= num * union
    return a[ok], b[ok]


def near_duplicates(
    docs: DataFrame,
    *,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    trees: int = TREES,
    sparse: tuple[int, ...] = SPARSE,
) -> DataFrame:
    """``doc_id`` (named ``id_col``), ``n_shingles``, ``component_id`` and ``kept`` for each row of ``docs``.

    A text's set is its distinct ``shingle``-word shingles (A-Z lower-cased; fewer words:
    the sequence as one; none: empty, linked with nothing). Two texts are linked if
    ``den * intersection >= num * union``; ``component_id`` is the smallest id reachable.

    Equal word sequences are one class, stood for by its smallest id. Each of ``trees`` orders sorts
    the classes by a rotation of their signatures; neighbours with a long common prefix are
    candidates. How long depends on the region: those who share the first value are compared whole
    if they are at most ``sparse[0]``, else parted by the second, and so on; after the last there is no limit.
    Members are compared by signature, and what could reach the bound on full sets; of
    the links found only a star per group leaves the task. Texts that are in no such pair are not exchanged.

    A crowded region is cut along its order into blocks. First only members of one block, and the
    blocks' first members, are compared: copies of one text are connected by that. Then the region's members
    are sorted by what they are connected with, and all pairs of blocks are compared but those
    that lie wholly in one component. So no pair between components is left out, and a group
    of n near copies costs about n. No region, block or partner is capped.

    Null ids: such a row is part of its class, but never stands for it; alone it has a
    null ``component_id``. ``kept``: the id is the component's (null with null). Rows
    repeated with one id have one answer each; different texts of one id link as one
    document. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bound = num / den
    error = ERRORS * np.sqrt(bound * (1 - bound) / HASHES)
    least = int(np.floor(HASHES * max(0.0, bound - error)))
    step = HASHES // trees

    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [normal(t) for t in batch]
            keys = [class_key(w) if w else (None, None) for w in words]
            sets = shingle_sets(words, shingle)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = [None] * len(words)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full], HASHES)):
                    sig[i] = row.tobytes()
            k1, k2 = zip(*keys) if keys else ((), ())
            yield pd.DataFrame({"k1": pd.array(k1, "Int64"), "k2": pd.array(k2, "Int64"), "n": [len(s) for s in sets], "sig": sig})

    signed = F.pandas_udf(sign, "k1 long, k2 long, n long, sig binary")
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = stored(base.select("_id", signed("_text").alias("s")), "near-rows").select("_id", "s.*")

    classes = rows.filter("k1 is not null").groupBy("k1", "k2").agg(F.min("_id").alias("rid"), F.first("sig").alias("sig"))
    classes = stored(classes.filter("rid is not null"), "near-classes")

    depth = len(sparse) + 1

    def keys_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch), np.uint32).reshape(len(batch), HASHES)
            out = np.zeros((len(batch), trees, depth), np.uint64)
            for t in range(trees):
                key = np.zeros(len(batch), np.uint64)
                for d in range(depth):  # a key for each length of the prefix
                    key = (key ^ sig[:, (t * step + d) % HASHES]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                    out[:, t, d] = key
            yield pd.Series([list(x) for x in out.view(np.int64)])

    keyed = classes.select("rid", F.posexplode(F.pandas_udf(keys_of, "array<array<bigint>>")("sig")).alias("tree", "keys"))
    rest, regions = stored(keyed, "near-keys"), []
    for d in range(depth):
        at = rest.withColumn("key", F.get("keys", F.lit(d)))
        shared = at.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = stored(shared.withColumnsRenamed({"tree": "_t", "key": "_k"}), "near-shared")
        found = at.join(shared, (F.col("tree") == F.col("_t")) & (F.col("key") == F.col("_k"))).drop("_t", "_k")
        crowded = F.col("n") > (sparse[d] if d < len(sparse) else F.lit(1 << 62))
        found = stored(found, "near-found") if d + 1 < depth else found
        # regions of each depth are numbered as orders of their own
        regions.append(found.filter(~crowded).select((F.col("tree") + d * trees).alias("tree"), "key", "n", "rid"))
        rest = found.filter(crowded).select("rid", "tree", "keys")
    members = reduce(DataFrame.unionByName, regions)
    sig = classes.select(F.col("rid").alias("_r"), "sig")
    members = members.join(sig, F.col("rid") == F.col("_r")).drop("_r")
    turn = f"(tree % {trees}) * {4 * step}"
    order = F.concat(F.expr(f"substring(sig, {turn} + 1, {4 * HASHES})"), F.expr(f"substring(sig, 1, {turn})"))
    placed = global_rank(members.withColumn("_order", order), ["tree", "key", "_order", "rid"], "at", "near-members").drop("_order")
    small = placed.filter(F.col("n") <= BLOCK).select("tree", "key", F.lit(0).alias("i"), F.lit(0).alias("j"), "rid", "sig", F.col("rid").alias("root"))
    hot = _blocks(placed.filter(F.col("n") > BLOCK), "near-hot").withColumn("root", F.col("rid"))
    inside = hot.select("tree", "key", F.col("b").alias("i"), F.col("b").alias("j"), "rid", "sig", "root")
    # the first members of so many blocks meet, and the last of these those of the next blocks
    group = F.floor(F.col("b") / (BLOCK - 1)).cast("int")
    groups = F.when((F.col("b") > 0) & (F.col("b") % (BLOCK - 1) == 0), F.array(group - 1, group)).otherwise(F.array(group))
    firsts = hot.filter("first").select("tree", "key", F.lit(-1).alias("i"), F.explode(groups).alias("j"), "rid", "sig", "root")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups of members that signatures do not tell apart, from rows sorted by block."""
        held = None
        for batch in _with_end(batches):
            if batch is not None and len(batch):
                held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if held is None or (batch is not None and not len(batch)):
                continue
            k = held[["tree", "key", "i", "j"]].to_numpy()
            new = np.r_[True, (k[1:] != k[:-1]).any(1)]
            starts = np.flatnonzero(new)
            end = len(held) if batch is None else int(starts[-1])
            if end == 0:
                continue
            rids, roots = (held[c].to_numpy(np.int64)[:end] for c in ("rid", "root"))
            s = np.frombuffer(b"".join(held.sig[:end]), np.uint32).reshape(end, HASHES)
            block = np.cumsum(new[:end]) - 1
            size = np.bincount(block)
            near_a, near_b = [], []
            for delta in range(1, int(size.max())):
                a = np.flatnonzero((block[:-delta] == block[delta:]) & (roots[:-delta] != roots[delta:]))
                ok = _alike(s, a, a + delta, least)
                near_a.append(a[ok])
                near_b.append(a[ok] + delta)
            if near_a and sum(map(len, near_a)):
                root = _roots(end, np.concatenate(near_a), np.concatenate(near_b))
                group, count = np.unique(root, return_counts=True)
                grouped = np.isin(root, group[count > 1])
                # the members' hash names the group: one that several orders find is looked at once
                out = pd.DataFrame({"g": root[grouped], "rid": rids[grouped]}).drop_duplicates().sort_values(["g", "rid"], kind="stable")
                names = out.groupby("g").rid.transform(lambda r: class_key(r.to_numpy().tobytes())[0])
                yield pd.DataFrame({"name": names.to_numpy(np.int64), "rid": out.rid.to_numpy()})
            held = held.iloc[end:].reset_index(drop=True) if batch is not None else None

    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rid", "_text"], kind="stable").drop_duplicates()
        rids = group.rid.to_numpy(np.int64)
        a, b = linked_pairs(shingle_sets([normal(t) for t in group._text], shingle), num, den)
        root = _roots(len(rids), a, b)
        other = np.flatnonzero(root != np.arange(len(rids)))
        return pd.DataFrame({"a": rids[other], "b": rids[root[other]]})

    def links_of(blocks: DataFrame) -> DataFrame:
        by_block = blocks.repartition("tree", "key", "i", "j").sortWithinPartitions("tree", "key", "i", "j", "rid")
        groups = stored(by_block.mapInPandas(compare, "name bigint, rid bigint").distinct(), "near-groups")
        wanted = groups.groupBy("rid").agg(F.collect_list("name").alias("names"))
        texts = among(base.select("_id", "_text").filter("_id is not null"), "_id", groups.select("rid"))
        # the same exchange at every size, so that what a run needs grows with its input
        texts = texts.join(wanted.hint("merge"), F.col("_id") == F.col("rid"))
        texts = texts.select(F.explode("names").alias("name"), "rid", "_text")
        return stored(texts.groupBy("name").applyInPandas(confirm, "a bigint, b bigint"), "near-links")

    links = links_of(small.unionByName(inside).unionByName(firsts))
    roots = stored(connected(links, "near-roots"), "near-roots")
    left = _apart(hot, roots)
    if left is not None:
        links = links.unionByName(links_of(left))
        roots = connected(links, "near-roots")
    of_class = classes.select("k1", "k2", "rid").join(roots, F.col("rid") == F.col("node"), "left")
    of_class = of_class.select(F.col("k1").alias("_c1"), F.col("k2").alias("_c2"), F.coalesce("root", "rid").alias("component_id"))
    of_class = stored(of_class, "near-components")
    found = rows.filter("k1 is not null").join(of_class, (F.col("k1") == F.col("_c1")) & (F.col("k2") == F.col("_c2")), "left")
    found = found.select("_id", "n", "component_id", "k1", "k2")
    alone = rows.filter("k1 is null").select("_id", "n", F.col("_id").alias("component_id"), "k1", "k2")
    return found.unionByName(alone).select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _blocks(members: DataFrame, name: str) -> DataFrame:
    """Members of large regions, ranked in ``at``, with their block ``b`` and whether they are its first."""
    members = stored(members, name)
    starts = members.groupBy("tree", "key").agg(F.min("at").alias("start")).withColumnsRenamed({"tree": "_t", "key": "_k"})
    rows = members.join(starts, (F.col("tree") == F.col("_t")) & (F.col("key") == F.col("_k"))).drop("_t", "_k")
    place = F.col("at") - F.col("start")
    return rows.withColumn("b", F.floor(place / BLOCK).cast("int")).withColumn("first", place % BLOCK == 0).drop("start", "at")


def _apart(hot: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Pairs of blocks of large regions that still hold members of several components; None without any.

    The members are sorted by component, so that a large one fills blocks of its own:
    two blocks of one component are no pair.
    """
    hot = hot.drop("root", "b", "first").join(roots, F.col("rid") == F.col("node"), "left")
    hot = stored(hot.withColumn("root", F.coalesce("root", "rid")).drop("node"), "near-apart")
    ends = [F.min("root").alias("lo"), F.max("root").alias("hi")]
    several = hot.groupBy("tree", "key").agg(*ends).filter("lo <> hi").select(F.col("tree").alias("_t"), F.col("key").alias("_k"))
    several = stored(several, "near-several")
    if several.isEmpty():
        return None
    rows = hot.join(several, (F.col("tree") == F.col("_t")) & (F.col("key") == F.col("_k"))).drop("_t", "_k")
    rows = _blocks(global_rank(rows, ["tree", "key", "root", "rid"], "at", "near-by-root"), "near-left")
    rows = stored(rows, "near-left")
    blocks = stored(rows.groupBy("tree", "key", "b").agg(*ends), "near-blocks")
    one, other = (blocks.withColumnsRenamed({"b": x, "lo": f"lo_{x}", "hi": f"hi_{x}"}) for x in ("i", "j"))
    pairs = one.join(other, ["tree", "key"]).filter("i <= j")
    pairs = pairs.filter("NOT (lo_i = hi_i AND lo_j = hi_j AND lo_i = lo_j)").select("tree", "key", "i", "j")
    both = pairs.withColumn("b", F.explode(F.array_distinct(F.array("i", "j"))))
    return rows.join(both, ["tree", "key", "b"]).select("tree", "key", "i", "j", "rid", "sig", "root")


def _with_end(batches):
    yield from batches
    yield None

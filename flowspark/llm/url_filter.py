"""URL filter: host rules first, then naive Bayes over segmented host and path names."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.session import ship_package

from .common import lower_ascii, stored, text_key

#: Longest known word. Longer stretches, and whole names of any length, can only stand as unknown ones.
WORD_CHARS = 40
#: A known word of two letters counts so much less than its occurrences say; single letters are no words.
SHORT_WORD = 1 / 50
#: Log odds are summed as whole millionths, so that no order of summing changes a verdict.
_UNIT = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``prefix`` is a host and the start of a path, such as ``example.com/en/``."""

    verdict: str
    prefix: str


def host_of(url: Column) -> Column:
    """What follows the first ``://``, A-Z lower-cased; empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "^[\\s\\S]*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "^[\\s\\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of the longest rule that fits (``prefix``, ``verdict``), else null."""
    found = F.lit(None).cast("struct<prefix:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.prefix), r.prefix)):
        rule_host, slash, rest = r.prefix.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(r.prefix).alias("prefix"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def names_of(text: Column) -> Column:
    """Names in a host or path: runs of letters and digits, numbers as ``0``."""
    found = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda t: t != "")
    return F.transform(found, lambda t: F.when(t.rlike("^[0-9]+$"), F.lit("0")).otherwise(t))


def _viterbi(name: str, log: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """Most likely split into known stretches ``log[start, end]`` and unknown ones of any length.

    An unknown stretch costs ``unknown`` and as much as ten letters to choose from per letter. Its best
    start does not depend on its end, so one running maximum serves for all.
    """
    letter = math.log(10)
    ending: dict[int, list[tuple[int, float]]] = {}
    for (start, end), cost in sorted(log.items()):
        ending.setdefault(end, []).append((start, cost))
    best, back, lead, lead_at = [0.0], [0], -math.inf, 0
    for end in range(1, len(name) + 1):
        if best[end - 1] + (end - 1) * letter > lead:
            lead, lead_at = best[end - 1] + (end - 1) * letter, end - 1
        top, at = lead + unknown - end * letter, lead_at
        for start, cost in ending.get(end, ()):
            if best[start] + cost > top:
                top, at = best[start] + cost, start
        best.append(top)
        back.append(at)
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented(names: DataFrame, unigrams: DataFrame) -> DataFrame:
    """``name, words``: each distinct name split by the counts ``word, n, bare`` (unigram Viterbi).

    ``bare`` counts the word's own standing as a name; it helps to split other names, never itself.

    The stretches of a name, two to ``WORD_CHARS`` long, meet the counts in a join, so
    that the word list is never held by one task.
    """
    ship_package(names.sparkSession)
    total = unigrams.agg(F.sum(F.col("n") + F.col("bare"))).first()[0] or 1
    begin = names.filter(F.length("name") > 1).select("name", F.explode(F.sequence(F.lit(1), F.length("name") - 1)).alias("start"))
    length = F.explode(F.sequence(F.lit(2), F.least(F.lit(WORD_CHARS), F.length("name") - F.col("start") + 1)))
    parts = begin.select("name", "start", length.alias("n_chars"))
    parts = parts.withColumn("word", F.substr("name", F.col("start"), F.col("n_chars")))
    others = F.col("n") + F.when(F.col("word") != F.col("name"), F.col("bare")).otherwise(0)
    known = parts.join(unigrams, "word").withColumn("n", others).filter("n > 0").groupBy("name").agg(F.collect_list(F.struct("start", "n_chars", "n")).alias("known"))
    unknown = math.log(10 / (10 * total))

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for name, rows in batches:
            out = []
            for text, found in zip(name, rows):
                log = {(r["start"] - 1, r["start"] - 1 + r["n_chars"]): math.log(r["n"] / total * (SHORT_WORD if r["n_chars"] == 2 else 1)) for r in ([] if found is None else found)}
                out.append(_viterbi(text, log, unknown))
            yield pd.Series(out)

    return names.join(known, "name", "left").select("name", split("name", "known").alias("words"))


def _evidence(urls: DataFrame, text: DataFrame | None) -> DataFrame:
    """``word, n``: separated parts of compound names, once per distinct compound, and words of texts, once per host.

    A text's word does not count on pages whose own url holds it as a name.
    """
    runs = F.array_union(F.split(F.lower("host"), "[.]"), F.split(F.lower("path"), "[./]"))
    runs = urls.select(F.explode(runs).alias("run")).distinct().select(F.array_distinct(names_of(F.col("run"))).alias("parts"), names_of(F.col("run")).alias("all"))
    words = runs.filter(F.size("all") > 1).select(F.explode("parts").alias("word"))
    if text is not None:
        own = F.concat(names_of(F.col("host")), names_of(F.col("path")))
        told = text.select("host", F.explode(F.array_except(names_of(F.col("text")), own)).alias("word")).distinct()
        words = words.unionByName(told.select("word"))
    return words.filter(F.length("word") <= WORD_CHARS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def judge(pages: DataFrame, rules: Sequence[Rule], *, url_col: str = "url", word_text: Column | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    A rule's verdict stands. Pages that rules decide are the training set of a
    multinomial naive Bayes (add one) over the words of host and path names, counted
    once per page; it decides all other pages: block if the log odds ``score`` of
    blocking are above 0, else allow (also with nothing to learn from). Names are split
    by unigram counts of the parts of compound names, once per distinct compound, of
    ``word_text`` (such as titles), once per host, and of other names that do not
    split themselves; how often a name itself occurs never holds it together. Null urls and those without ``://`` have an empty host and path; the
    prior alone decides them. Work is done per distinct (host, path). Input columns
    named like an added one are replaced.
    """
    added = ("host", "path", "rule", "verdict", "score")
    url = F.col(url_col).cast("string")
    rows = pages.select(F.struct(*[c for c in pages.columns if c not in added]).alias("_row"), host_of(url).alias("host"), path_of(url).alias("path"))
    key = text_key(F.concat("host", F.lit("\n"), "path"))
    rows = rows.select("*", key[0].alias("_u1"), key[1].alias("_u2"))
    urls = rows.groupBy("_u1", "_u2").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.count(F.lit(1)).alias("n"))
    urls = stored(urls.withColumn("r", matching_rule(F.col("host"), F.col("path"), rules)), "url-distinct")

    names = urls.select("_u1", "_u2", "n", "r", F.explode(F.concat(names_of(F.col("host")), names_of(F.col("path")))).alias("name"))
    text = None
    if word_text is not None:
        text = pages.select(host_of(url).alias("host"), path_of(url).alias("path"), F.coalesce(word_text, F.lit("")).alias("text"))
    evidence = stored(_evidence(urls, text), "url-evidence")
    distinct = stored(names.select("name").distinct(), "url-distinct-names")

    def with_bare(bare: DataFrame) -> DataFrame:
        bare = bare.filter(F.length("name") <= WORD_CHARS).select(F.col("name").alias("word"), F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("bare"))
        both = evidence.select("word", "n", F.lit(0).cast("long").alias("bare")).unionByName(bare)
        return stored(both.groupBy("word").agg(F.sum("n").alias("n"), F.sum("bare").alias("bare")), "url-words")

    # names that the others split are no words of further names
    whole = stored(segmented(distinct, with_bare(distinct)), "url-first-split").filter(F.size("words") == 1)
    split = stored(segmented(distinct, with_bare(whole.select("name"))), "url-names")

    # counts of (name, verdict) first: the words of a name are then summed once per name
    ruled = F.when(F.col("r.verdict") == "block", F.col("n")).otherwise(0)
    by_name = names.filter(F.col("r").isNotNull()).groupBy("name").agg(F.sum(ruled).alias("b"), F.sum("n").alias("all"))
    by_word = by_name.join(split, "name").select(F.explode("words").alias("word"), "b", "all")
    by_word = stored(by_word.groupBy("word").agg(F.sum("b").alias("b"), F.sum("all").alias("all")), "url-counts")
    totals = by_word.agg(F.sum("b"), F.sum("all"), F.count(F.lit(1))).first()
    n_block, n_all, vocabulary = totals[0] or 0, totals[1] or 0, totals[2] + 1
    classes = urls.agg(F.sum(ruled), F.sum(F.when(F.col("r").isNotNull(), F.col("n")))).first()
    blocked, judged = classes[0] or 0, classes[1] or 0
    rate = lambda b, a: F.log((b + 1) / (n_block + vocabulary)) - F.log((a + 1) / (n_all - n_block + vocabulary))
    prior = round(_UNIT * (math.log((blocked + 1) / (judged + 2)) - math.log((judged - blocked + 1) / (judged + 2))))
    odds = by_word.select("word", F.round(rate(F.col("b"), F.col("all") - F.col("b")) * _UNIT).cast("long").alias("odds"))
    unseen = round(_UNIT * (math.log(1 / (n_block + vocabulary)) - math.log(1 / (n_all - n_block + vocabulary))))
    of_name = split.select("name", F.explode("words").alias("word")).join(odds, "word", "left")
    of_name = stored(of_name.groupBy("name").agg(F.sum(F.coalesce("odds", F.lit(unseen))).alias("odds")), "url-odds")

    # both sides scans: Spark can split the rows of a name that every url has
    scored = names.filter(F.col("r").isNull()).select("_u1", "_u2", "name").join(of_name, "name")
    scored = scored.groupBy("_u1", "_u2").agg(F.sum("odds").alias("odds"))
    verdicts = urls.join(scored, ["_u1", "_u2"], "left").select(
        F.col("_u1").alias("_v1"),
        F.col("_u2").alias("_v2"),
        "r",
        F.when(F.col("r").isNull(), (prior + F.coalesce("odds", F.lit(0))) / _UNIT).alias("score"),
    )
    verdicts = stored(verdicts, "url-verdicts")
    judged_rows = rows.join(verdicts, (F.col("_u1") == F.col("_v1")) & (F.col("_u2") == F.col("_v2")))
    by_score = F.when(F.col("score") > 0, F.lit("block")).otherwise("allow")
    return judged_rows.select("_row.*", "host", "path", F.col("r.prefix").alias("rule"), F.coalesce("r.verdict", by_score).alias("verdict"), "score")

"""Query of the URL filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .registry import query
from .url_filter import Rule, judge

RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


@query("op5_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    title = F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)
    return judge(pages, RULES, word_text=title).select("page_id", "host", "path", "rule", "verdict", "score")

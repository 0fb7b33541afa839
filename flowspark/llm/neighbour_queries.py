"""Query of the approximate nearest neighbours. Which neighbours an index misses is not for SQL; tests hold it against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .projection_forest import nearest_neighbours
from .registry import query


@query("op11_nearest_neighbours")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)

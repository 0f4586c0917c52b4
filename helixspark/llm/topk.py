"""The first rows of each key without sorting a whole key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares of a key that are ranked apart first.
SHARES = 64


def first_rows(df: DataFrame, keys: list[str], order: list[Column], k: int, salt: list[str], name: str = "rank") -> DataFrame:
    """The ``k`` first rows of each key by ``order`` with their place from 1. Rows are ranked in
    ``SHARES`` shares of a key (by the hash of ``salt``), then the at most ``SHARES * k`` left."""
    share = F.pmod(F.xxhash64(*salt), F.lit(SHARES))
    part = df.withColumn("__share", share).withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "__share").orderBy(*order)))
    part = part.where(F.col("__r") <= k).drop("__share", "__r")
    return part.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)

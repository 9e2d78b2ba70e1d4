"""The best row of a group, with ties decided by stated columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with the 1-based place of each row in its group; ``order`` must decide every tie that matters."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group; tasks keep only their own first ``n`` before the shuffle."""
    return ranked(df, keys, order, "__rank").filter(F.col("__rank") <= n).drop("__rank")

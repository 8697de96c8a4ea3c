"""First rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_per(
    df: DataFrame,
    keys: Sequence[str],
    k: int,
    time: str = "pubdate",
    ties: Sequence[str] = (),
    null_first: bool = False,
) -> DataFrame:
    """The ``k`` newest rows of each group, numbered in ``rn``.

    Spark cuts every map task's groups to ``k`` rows before the shuffle (a window
    group limit), so a hot group moves at most ``k`` rows per task. Rows without
    a time come last; ``null_first`` lets them come first, as in engines that
    sort nulls high.
    """
    newest = F.col(time).desc_nulls_first() if null_first else F.col(time).desc_nulls_last()
    order = [newest, *[F.col(name).asc_nulls_last() for name in ties]]
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rn") <= k)


def first_per(df: DataFrame, keys: Sequence[str], k: int, order: Sequence) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, numbered in ``rn``."""
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rn") <= k)

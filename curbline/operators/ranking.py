"""Top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    by: Sequence[str],
    score: str,
    k: int,
    tiebreak: Sequence[str] = (),
    keep_ties: bool = False,
    pinned: Column | None = None,
    rank_name: str = "rank",
) -> DataFrame:
    """The ``k`` rows with the highest score in each group.

    Equal scores are ordered by ``tiebreak`` so that reruns pick the same rows, or all
    kept with ``keep_ties`` (then ranks repeat and a group may exceed ``k``). Rows that
    match ``pinned`` are kept whatever their rank.

    Meant for already aggregated input: ranking sorts a group in one task, though Spark
    prunes each partition to ``k`` rows before the shuffle unless rows are pinned.
    """
    order = [F.col(score).desc(), *[F.col(c).asc() for c in tiebreak]]
    window = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn(rank_name, (F.rank() if keep_ties else F.row_number()).over(window))
    wanted = F.col(rank_name) <= k
    return ranked.where(wanted if pinned is None else wanted | pinned)

"""Spreading rows that come in too few partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textpulse.session import ready_checkpoints


def spread_rows(rows: DataFrame, key: str, waves: int = 1, store: bool = False) -> DataFrame:
    """Rows over at least ``waves`` partitions per task slot of the cluster.

    A few large files, or files of one row group, would leave most of the cluster idle
    during heavy work on text; such rows are spread by their (unique) key. A scan that
    has enough partitions is returned as it is, without a shuffle, so what is ever
    shuffled is less than one wave of scan tasks. ``store=True`` also writes spread
    rows once, for work that reads them many times.

    Call it on a scan with filters, not after a join or a grouping.
    """
    wanted = waves * rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= wanted:
        return rows
    spread = rows.repartition(wanted, key)
    if not store:
        return spread
    ready_checkpoints(rows.sparkSession)
    return spread.checkpoint()

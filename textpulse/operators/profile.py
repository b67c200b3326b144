"""One-pass profiles of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass; zero, not null, for an empty table."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: count, mean, stddev, min and max, from one aggregate.

    Text columns have a null mean and stddev, and min and max are given as text.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    wanted = list(columns or df.columns)
    missing = F.lit(None).cast("double")

    def measures(name: str):
        value = F.col(name)
        is_number = name in numeric
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("n"),
            (F.avg(value) if is_number else missing).alias("mean"),
            (F.stddev_samp(value) if is_number else missing).alias("stddev"),
            F.min(value).cast("string").alias("min"),
            F.max(value).cast("string").alias("max"),
        ).alias(name)

    one_row = df.agg(*[measures(c) for c in wanted])
    return one_row.select(F.inline(F.array(*[F.col(c) for c in wanted])))


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 20) -> DataFrame:
    """The first rows for display, in a stated order."""
    return df.orderBy(*order_by).limit(rows)

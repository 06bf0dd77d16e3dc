"""As-of joins: for each left row the latest right row of its key that isn't later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def intervals(right: DataFrame, key: str, at: str, ties: list[Column] | None = None) -> DataFrame:
    """The right side with `until`, where its next row of the key begins; rows without key or place can't match and go.

    Of rows with equal key and place one stays, the first by `ties`.
    """
    right = right.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    once = F.row_number().over(Window.partitionBy(key, at).orderBy(*(ties or [F.lit(0)])))
    right = right.withColumn("__n", once).filter("__n = 1").drop("__n")
    return right.withColumn("until", F.lead(at).over(Window.partitionBy(key).orderBy(at)))


def asof_left_join(left: DataFrame, right: DataFrame, left_key: str, left_at: str, right_key: str, right_at: str, ties: list[Column] | None = None, small: bool = False) -> DataFrame:
    """All left rows, each with at most one right row. Column names of the sides must differ.

    The right side's rows become intervals that don't overlap, so that an equality and a range find at most one. small:
    send the right side to every task, whose bound the caller knows; by default run-time statistics decide.
    """
    right = intervals(right, right_key, right_at, ties)
    right = F.broadcast(right) if small else right
    inside = (F.col(left_at) >= F.col(right_at)) & (F.col("until").isNull() | (F.col(left_at) < F.col("until")))
    return left.join(right, (F.col(left_key) == F.col(right_key)) & inside, "left").drop("until")

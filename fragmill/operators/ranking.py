"""Row numbers and last rows that no single task has to see whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fragmill.session import work_folder


def numbered(rows: DataFrame, order: list, out: str) -> DataFrame:
    """rows with out, their number from 1 in an order without ties.

    Rows are dealt to ranges of the order and numbered within each; the counts of
    the ranges before, one row for each, are added. The ranges are written once, so
    that both see the same.
    """
    spark = rows.sparkSession
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    names = [f"_key_{i}" for i in range(len(keys))]
    ranged = rows.select("*", *[k.alias(n) for k, n in zip(keys, names)]).repartitionByRange(*names)
    folder = f"{work_folder(spark)}/ranges"
    ranged.withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    held = spark.read.parquet(folder)
    local = held.withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(*names)))
    counts = held.groupBy("_range").agg(F.count("*").alias("_count"))  # a row for each range
    before = F.coalesce(F.sum("_count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_range", before.alias("_before"))
    return local.join(starts, "_range").withColumn(out, F.col("_n") + F.col("_before")).select(*rows.columns, out)


def numbered_within(rows: DataFrame, keys: list[str], order: list, out: str) -> DataFrame:
    """rows with out, their number from 1 within each key in an order without ties: their number among all, less that of the key's first.

    So a key with many rows is numbered by as many tasks as it fills ranges. Null keys are one key.
    """
    every = numbered(rows, [*keys, *order], "_place")
    least = every.groupBy(*[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)]).agg(F.min("_place").alias("_least"))
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)])
    return every.join(least, match).select(*rows.columns, (F.col("_place") - F.col("_least") + 1).alias(out))


def last(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last by an order without ties: an aggregate, so a hot key costs a row a task."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], *rest)).alias("_last"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns])


def first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is seen first by an order without ties; an aggregate likewise."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], *rest)).alias("_first"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in rows.columns])

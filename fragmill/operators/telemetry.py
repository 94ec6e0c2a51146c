"""Builds, shards, ledgers and logs: completeness, progress and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragmill.operators.ranking import last


def rate(amount: Column, seconds: Column, digits: int = 3) -> Column:
    """amount a second, 0 where no time has passed."""
    return F.coalesce(F.round(F.try_divide(amount, F.when(seconds > 0, seconds)), digits), F.lit(0.0))


def missing(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that are not done: pending shards, absent molecules, files no ledger has."""
    return expected.join(done.select(*keys).distinct(), keys, "left_anti")


def latest(ledger: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last entry of each key."""
    return last(ledger, keys, order)


def planned(molecules: DataFrame, units: str, wanted: int, buckets: int) -> DataFrame:
    """A row for each shard: as many roots as there are units, at most the wanted number, times the buckets."""
    shards = F.least(F.greatest(F.col(units), F.lit(1)), F.lit(wanted)) * buckets
    return molecules.withColumn("shard", F.explode(F.sequence(F.lit(0), shards.cast("int") - 1)))


def tail(plan: DataFrame, done: DataFrame, near: int) -> DataFrame:
    """(molecule_id, total, done, missing, nearly): how far each molecule's shards are."""
    totals = plan.groupBy("molecule_id").agg(F.count("*").alias("total"))
    ready = done.select("molecule_id", "shard").distinct().groupBy("molecule_id").agg(F.count("*").alias("done"))
    rows = totals.join(ready, "molecule_id", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    return rows.withColumn("missing", F.col("total") - F.col("done")).withColumn("nearly", F.col("missing").between(1, near))


def validation(expected: DataFrame, markers: DataFrame, files: DataFrame) -> DataFrame:
    """One row of a build's metrics and ok: nothing is missing, unfinished or changed.

    expected and markers have molecule_id; files has name, bytes and intact, whether
    its checksum is the one recorded.
    """
    done = expected.join(markers.select("molecule_id").distinct().withColumn("_done", F.lit(True)), "molecule_id", "left")
    parquet = F.col("name").endswith(".parquet")
    of_molecules = done.agg(F.count("*").alias("expected_molecule_count"), F.count("_done").alias("success_molecule_count"), F.count_if(F.col("_done").isNull()).alias("missing_success_count"))
    of_files = files.agg(
        F.count_if(F.col("name").endswith(".tmp")).alias("tmp_file_count"), F.count_if(parquet & ~F.coalesce("intact", F.lit(False))).alias("bad_checksum_count"),
        F.count_if(parquet).alias("total_parquet_files"), F.coalesce(F.sum(F.when(parquet, F.col("bytes"))), F.lit(0)).alias("total_parquet_size_bytes"),
    )
    ok = (F.col("missing_success_count") == 0) & (F.col("tmp_file_count") == 0) & (F.col("bad_checksum_count") == 0)
    both = of_molecules.withColumn("_one", F.lit(1)).join(of_files.withColumn("_one", F.lit(1)), "_one").drop("_one")  # one row each
    return both.withColumn("ok", ok)


def numeric_first(column: str) -> list[Column]:
    """Order keys: numbers by value, then all else by text."""
    number = F.when(F.col(column).rlike("^[0-9]+$"), F.col(column).cast("decimal(38,0)"))
    return [number.isNull(), number, F.col(column)]


def score(nonring: Column, rotatable: Column, branches: Column, heavy: Column, hetero: Column) -> Column:
    """How hard a molecule is likely to be."""
    # Fixed values.
    return 0.23 * nonring + 0.13 * rotatable + 0.06 * branches + 0.04 * heavy + 0.02 * hetero


def running(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """rows with chunk, their number from 1 within the key, and so_far, the sum of values up to them."""
    window = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("chunk", F.row_number().over(window)).withColumn("so_far", F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0)))


def label_frequencies(rows: DataFrame, column: str, top: int) -> DataFrame:
    """(labels): the most frequent of labels joined by ';', as they are, as "label:count" joined by '; '."""
    each = rows.select(F.explode(F.split(column, ";")).alias("label")).where("label <> ''")
    best = each.groupBy("label").count().orderBy(F.col("count").desc(), "label").limit(top)
    line = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("n"), F.concat_ws(":", "label", "count").alias("t"))))
    return best.agg(F.array_join(F.transform(line, lambda x: x["t"]), "; ").alias("labels"))

"""Writers: partitioned Parquet, checksums, an import ledger, CSV and JSON lines."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragmill.operators.ranking import numbered, numbered_within
from fragmill.operators.telemetry import missing
from fragmill.session import work_folder

LEDGER = ["path", "bytes", "modified", "target"]


def write_fragments(rows: DataFrame, path: str, rows_per_file: int = 200_000, overwrite: bool = False) -> None:
    """Fragments by molecule as zstd Parquet, sorted so that readers can skip; Spark's committer makes the write atomic."""
    keys = ["molecule_id", "atom_count", "bond_count"]
    # A molecule with more rows than a file holds is dealt to as many tasks as it has files.
    files = rows.groupBy("molecule_id").agg(F.ceil(F.count("*") / rows_per_file).alias("_files"))
    dealt = rows.join(files, "molecule_id").repartition("molecule_id", F.pmod(F.xxhash64(*[c for c in rows.columns]), F.col("_files"))).drop("_files")
    writer = dealt.select(*rows.columns).sortWithinPartitions(*keys).write.mode("overwrite" if overwrite else "errorifexists")
    writer.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy("molecule_id").parquet(path)


def write_reports(molecules: DataFrame, path: str) -> None:
    """Of (molecule_id, status, fragment_rows, elapsed_seconds, error): failed_molecules and build_summary below a folder, as JSON lines."""
    status = F.col("status")
    molecules.where(status == "failed").select("molecule_id", "error").write.mode("overwrite").json(f"{path}/failed_molecules")
    molecules.agg(
        F.count("*").alias("total"), F.count_if(status == "success").alias("success"), F.count_if(status == "skipped").alias("skipped"),
        F.count_if(status == "failed").alias("failed"), F.coalesce(F.sum("fragment_rows"), F.lit(0)).alias("fragment_rows"),
        F.coalesce(F.sum("elapsed_seconds"), F.lit(0.0)).alias("elapsed_seconds"),
    ).write.mode("overwrite").json(f"{path}/build_summary")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of every Parquet file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def broken(manifest: DataFrame, now: DataFrame) -> DataFrame:
    """(path, reason) of files that a manifest has and that are missing or changed."""
    found = manifest.join(now.select("path", F.col("sha256").alias("_now")), "path", "left")
    reason = F.when(F.col("_now").isNull(), "missing").when(F.col("_now") != F.col("sha256"), "changed")
    return found.select("path", reason.alias("reason")).where("reason is not null")


def to_import(listing: DataFrame, ledger: DataFrame, target: str) -> DataFrame:
    """Files that the ledger does not have for this target, by path, size and time."""
    return missing(listing.withColumn("target", F.lit(target)), ledger, LEDGER)


def import_new(spark: SparkSession, listing: DataFrame, ledger_path: str, target: str, columns: list[str], dry_run: bool = False) -> tuple[int, int]:
    """Appends new files to a table and then records them; (imported, skipped) files.

    A run that fails between the two imports its files again: at least once, as
    states that are merged by key allow.
    """
    try:
        ledger = spark.read.parquet(ledger_path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        ledger = listing.limit(0).withColumn("target", F.lit(target))
    new = to_import(listing, ledger, target)
    paths = [r["path"] for r in new.select("path").toLocalIterator()]
    if paths and not dry_run:
        spark.read.parquet(*paths).select(*columns).write.mode("append").parquet(target)
        new.select(*LEDGER).write.mode("append").parquet(ledger_path)
    return len(paths), listing.count() - len(paths)


class Imported(NamedTuple):
    """How many files came in, were in the ledger, and could not be read, and what is known of the last (path, error)."""

    imported: int
    skipped: int
    failed: int
    failures: DataFrame


def _loaded(files: DataFrame, schema: T.StructType) -> DataFrame:
    """(path, error, row) of files that tasks open one by one: a row for each of a file's, or one with why it cannot be read.

    A file is read whole before its first row is given, so none comes in by halves.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    out = pa.schema([("path", pa.string()), ("error", pa.string()), ("row", pa.struct(list(arrow)))])

    def one(path: str) -> pa.Table:
        from pyarrow import fs, parquet

        system, place = fs.FileSystem.from_uri(path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
        with system.open_input_file(place) as file:
            return parquet.read_table(file, columns=arrow.names).select(arrow.names).cast(arrow).combine_chunks()

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    table = one(path)
                except (OSError, KeyError, ValueError, NotImplementedError) as error:  # pyarrow's own errors are of these kinds
                    yield pa.RecordBatch.from_pylist([{"path": path, "error": str(error)[:1000] or type(error).__name__, "row": None}], out)
                    continue
                for part in table.to_batches(max_chunksize=50_000):
                    row = pa.StructArray.from_arrays(part.columns, fields=list(arrow))
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.nulls(len(part), pa.string()), row], schema=out)

    kind = T.StructType([T.StructField("path", T.StringType()), T.StructField("error", T.StringType()), T.StructField("row", schema)])
    return files.select("path").repartition("path").mapInArrow(load, kind)


def import_files(
    spark: SparkSession, listing: DataFrame, ledger_path: str, target: str, schema: T.StructType, limit_molecules: int | None = None, limit_files: int | None = None,
    continue_on_error: bool = False, reimport: bool = False, dry_run: bool = False,
) -> Imported:
    """Appends new files of a listing (path, bytes, modified, and molecule_id if molecules are limited) to a table and records them.

    Limits take the first molecules and then the first files by name; one below 0 is
    an error. Files are opened inside tasks, and their paths never come to the
    driver. Those that cannot be read are failed and are tried again next time;
    unless continue_on_error is set, one of them keeps the whole run from importing.
    Rows are written to a shared folder first, so a run that ends there leaves the
    table as it was; one that ends between table and ledger imports again.
    """
    if any(n is not None and n < 0 for n in (limit_molecules, limit_files)):
        raise ValueError("a limit is negative")
    if limit_molecules is not None:
        listing = listing.join(listing.select("molecule_id").distinct().orderBy("molecule_id").limit(limit_molecules), "molecule_id")
    if limit_files is not None:
        listing = listing.orderBy("path").limit(limit_files)
    new, total = listing.withColumn("target", F.lit(target)), listing.count()
    if not reimport:
        try:
            new = to_import(listing, spark.read.parquet(ledger_path), target)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    folder = work_folder(spark)
    new.select(*LEDGER).write.parquet(f"{folder}/files")
    new = spark.read.parquet(f"{folder}/files")
    skipped = total - new.count()
    if dry_run:
        return Imported(0, skipped, 0, new.select("path", F.lit(None).cast("string").alias("error")).limit(0))
    loaded = _loaded(new, schema)
    loaded.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(loaded.schema).parquet(f"{folder}/rows")
    failures = rows.where("error is not null").select("path", "error")
    failed = failures.count()
    if failed and not continue_on_error:
        return Imported(0, skipped, failed, failures)
    good = new.join(failures, "path", "left_anti")
    rows.where("error is null").select("row.*").write.mode("append").parquet(target)
    good.select(*LEDGER).write.mode("append").parquet(ledger_path)
    return Imported(total - skipped - failed, skipped, failed, failures)


def export_csv(rows: DataFrame, path: str, columns: list[str] | None = None, limit: int | None = None) -> None:
    """CSV with a header; a limit below 0 is an error."""
    if limit is not None and limit < 0:
        raise ValueError("limit is negative")
    rows = rows.select(*columns) if columns else rows
    (rows if limit is None else rows.limit(limit)).write.option("header", True).csv(path)


def report(rows: DataFrame, order: list[str], by: str | None = None) -> DataFrame:
    """rows with index, their number from 1 in an order, within each value of by if given."""
    if by is None:
        return numbered(rows, order, "index")
    return numbered_within(rows, [by], order, "index")


def append_audit(records: DataFrame, path: str) -> None:
    """Audit records as JSON lines by day."""
    records.withColumn("day", F.substring("timestamp", 1, 10)).write.mode("append").partitionBy("day").json(path)

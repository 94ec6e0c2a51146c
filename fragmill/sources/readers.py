"""Readers of molecule lists, fragment builds, markers, logs and databases. Connections come from the caller alone."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragmill.functions.scalars import column_at, path_molecule, split_trimmed

MOLECULES = "molecule_id string, smiles string"
SUCCESS = "molecule_id string, status string, chunk_count long, fragment_rows long, elapsed_seconds double, min_atoms int, max_atoms int"
#: Fixed value: the characters that tell SMILES from a heading.
SMILES_MARKS = "CNOSPFIcnops()=#@[]"
AUDIT = (
    "timestamp string, request_id string, client_ip string, listen_port int, method string, path string, "
    "user_id string, user_id_source string, status_code int, duration_ms double, error string"
)


def molecules(spark: SparkSession, path: str, id_column: str = "molecule_id", smiles_column: str = "smiles", strict: bool = True) -> DataFrame:
    """(molecule_id, smiles) of a CSV or TSV file with a header, trimmed.

    strict raises on a blank SMILES when the row is read; else blank rows are
    dropped. A missing column raises at once.
    """
    read = spark.read.option("header", True).option("sep", "\t" if path.lower().endswith((".tsv", ".tsv.gz")) else ",")
    rows = read.csv(path)
    clean = {c.lstrip("﻿").strip(): c for c in rows.columns}
    lost = {id_column, smiles_column} - set(clean)
    if lost:
        raise ValueError(f"{path} lacks {sorted(lost)}")
    rows = rows.select(
        F.trim(F.col(f"`{clean[id_column]}`")).alias("molecule_id"), F.trim(F.col(f"`{clean[smiles_column]}`")).alias("smiles")
    )
    blank = (F.coalesce("smiles", F.lit("")) == "") | (F.coalesce("molecule_id", F.lit("")) == "")
    if not strict:
        return rows.where(~blank)
    checked = F.when(blank, F.raise_error(F.lit("a row without an id or a SMILES"))).otherwise(F.col("smiles"))
    return rows.withColumn("smiles", checked)


def named_smiles(rows: DataFrame, number: str, name: str, smiles: str) -> DataFrame:
    """(name, smiles) of a sheet's first two columns, trimmed; number counts its rows from 0.

    Rows without SMILES are dropped, and so is the first row if its SMILES has no
    character of one, as it then is a heading. A row without a name is named
    drug_ and its number from 1.
    """
    text = F.trim(smiles)
    heading = (F.col(number) == 0) & (F.translate(text, SMILES_MARKS, "") == text)
    named = F.when(F.coalesce(name, F.lit("")) == "", F.concat(F.lit("drug_"), (F.col(number) + 1).cast("string"))).otherwise(F.trim(name))
    return rows.where((text != "") & ~heading).select(named.alias("name"), text.alias("smiles"))


def expected_ids(spark: SparkSession, path: str) -> DataFrame:
    """(molecule_id) as numbers, one to a line."""
    return spark.read.schema("molecule_id int").csv(path)


def drugs(spark: SparkSession, path: str, number: str, ingredients: str) -> DataFrame:
    """(drug_number, ingredients array) by column header, number or letters; rows without an ingredient are dropped."""
    if not path.lower().endswith(".csv"):
        raise ValueError("only CSV files are read; save spreadsheets as CSV")
    rows = spark.read.option("header", True).csv(path)
    names = (column_at(rows.columns, number), column_at(rows.columns, ingredients))
    found = rows.select(F.col(f"`{names[0]}`").alias("drug_number"), split_trimmed(F.col(f"`{names[1]}`")).alias("ingredients"))
    return found.where(F.size("ingredients") > 0)


def fragment_build(spark: SparkSession, root: str, parts: bool = False) -> DataFrame:
    """Fragments of a build's finished chunks; with parts, of unfinished shards as well. molecule_id is a string."""
    glob = "{chunk_*.parquet,shard-*.chunk-*.parquet}" if parts else "chunk_*.parquet"
    rows = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).parquet(root)
    if "molecule_id" not in rows.columns:
        rows = rows.withColumn("molecule_id", path_molecule(F.input_file_name()))
    return rows.withColumn("molecule_id", F.col("molecule_id").cast("string")).withColumn("src_file", F.input_file_name())


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, bytes, modified) below a folder by the glob of a name, whose leading underscore hides none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    glob = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern)
    found, walk = [], system.listFiles(hadoop, True)
    while walk.hasNext():
        status = walk.next()
        if glob.matches(status.getPath().getName()):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return spark.createDataFrame(found, "path string, bytes long, modified long")


def _content(listing: DataFrame) -> DataFrame:
    """(path, content) of listed files, opened inside tasks: their names hide them from Spark's own readers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
                with system.open_input_stream(place) as stream:
                    text = stream.read().decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([text])], names=["path", "content"])

    return listing.select("path").repartition("path").mapInArrow(read, "path string, content string")


def success_markers(spark: SparkSession, root: str) -> DataFrame:
    """(path, the fields of SUCCESS, broken) of every _SUCCESS below a folder; the id is the marker's or the path's."""
    rows = _content(files(spark, root, "_SUCCESS"))
    parsed = rows.withColumn("j", F.from_json("content", SUCCESS))
    fields = [F.col(f"j.{f.name}").alias(f.name) for f in T.StructType.fromDDL(SUCCESS) if f.name != "molecule_id"]
    return parsed.select(
        "path",
        F.coalesce("j.molecule_id", path_molecule(F.col("path"))).alias("molecule_id"),
        *fields,
        F.col("j.status").isNull().alias("broken"),
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ts, molecule_id, line) of log lines that begin with a time and name a molecule."""
    rows = spark.read.text(path)
    stamp = F.regexp_extract("value", r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(?:,(\d{3}))?", 0)
    return rows.select(
        F.try_to_timestamp(F.replace(stamp, F.lit(","), F.lit("."))).alias("ts"),
        F.nullif(F.regexp_extract("value", r"molecule_id=(\S+)", 1), F.lit("")).alias("molecule_id"),
        F.col("value").alias("line"),
    ).where("ts is not null and molecule_id is not null")


def audit_records(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Audit records of JSON lines, once or as a stream."""
    return (spark.readStream if stream else spark.read).schema(AUDIT).json(path)


def jdbc(spark: SparkSession, options: dict[str, str], table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1) -> DataFrame:
    """A database table by the caller's options, in ranges of a key where bounds are given."""
    read = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if key and bounds:
        read = read.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return read.load()


def column_named(df: DataFrame, *candidates: str) -> str:
    """The first of the candidate names that df has, in any case."""
    have = {c.lower(): c for c in df.columns}
    for name in candidates:
        if name.lower() in have:
            return have[name.lower()]
    raise ValueError(f"none of {candidates} among {df.columns}")


def looked_up(rows: DataFrame, name: str, cache: DataFrame) -> DataFrame:
    """rows with smiles of a cache (name, smiles), by name in any case; null where it has none."""
    known = cache.select(F.upper(F.trim("name")).alias("_name"), F.col("smiles")).dropDuplicates(["_name"])
    return rows.join(known, F.upper(F.trim(F.col(name))) == F.col("_name"), "left").drop("_name")


def compound_smiles(json: Column) -> Column:
    """The SMILES of a compound record, whichever of its names it has; empty ones do not count."""
    # Fixed values, in the order they are looked for.
    names = ["IsomericSMILES", "CanonicalSMILES", "SMILES", "ConnectivitySMILES"]
    return F.coalesce(*[F.nullif(F.get_json_object(json, f"$.PropertyTable.Properties[0].{n}"), F.lit("")) for n in names])


def rows_by_file(spark: SparkSession, path: str) -> DataFrame:
    """(file, n): rows of each Parquet file below a folder."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return rows.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))

"""Shards on a shared file system: small immutable appends, size-tiered compaction, versioned manifests."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

#: A run of so many shards of one tier is merged; a tier spans sizes up to that factor.
FAN_IN = 4
TARGET_BYTES = 128 << 20
#: Versions that vacuum keeps readable, and the age in seconds at which files that no version has ever named are leftovers.
RETAIN, LEFTOVER_AGE = 2, 7 * 86_400
#: Times that a writer tries again after another has committed first.
TRIES = 20
#: Shards whose numbers are broadcast when a version is read, some 100 bytes each; those of more are joined.
BROADCAST_SHARDS = 100_000

_MANIFEST = "shard string, bytes long, tier int"


class Conflict(Exception):
    """Another writer has committed the version first."""


class ShardStore:
    """A table of immutable Parquet shards of one schema below one folder.

    data/ holds shards, each in the folder of the write that made it; manifests/
    holds one Parquet table of live shards for each version, and versions/ one
    small file for each, which names the manifest. That file is written aside and
    then put in place whole by a rename (on a local disk: a link) that fails if
    the version is there: the commit. Readers so see a version whole or not at
    all, a writer that dies at any point leaves only files that no version names,
    and of two writers the later one tries again upon the other's version. The
    versions that vacuum() retains stay readable.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN) -> None:
        self.spark, self.path, self.target, self.fan_in = spark, path.rstrip("/"), target_bytes, fan_in
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _list(self, path: str) -> list[str]:
        fs, place = self._fs(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []

    def _delete(self, path: str) -> bool:
        fs, place = self._fs(path)
        return bool(fs.delete(place, True))

    def versions(self) -> list[int]:
        """The versions that can be read, the last one last."""
        return [int(name) for name in self._list(f"{self.path}/versions") if name.isdigit()]

    def version(self) -> int:
        """The last version; 0 before the first commit."""
        return (self.versions() or [0])[-1]

    def _manifest_name(self, version: int) -> str:
        fs, place = self._fs(f"{self.path}/versions/{version:010d}")
        if not fs.exists(place):
            raise LookupError(f"there is no version {version}, or it was vacuumed")
        stream = fs.open(place)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        """(shard, bytes, tier) of a version's live shards; none before the first commit."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests/{self._manifest_name(version)}")

    def _publish(self, path: str, content: str) -> None:
        """Makes a file appear with its content at once; Conflict if there is one."""
        jvm = self.spark._jvm
        fs, place = self._fs(path)
        _, draft = self._fs(f"{self.path}/drafts/{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(content.encode()))
        stream.close()
        fs.mkdirs(place.getParent())
        place, draft = fs.makeQualified(place), fs.makeQualified(draft)
        try:
            if fs.getUri().getScheme() == "file":
                at = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(at(place), at(draft))
            else:
                none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, place, none)
        except Py4JJavaError as failed:
            if not failed.java_exception.getClass().getSimpleName().startswith("FileAlreadyExists"):
                raise
            raise Conflict(f"{path} is there already") from failed
        finally:
            fs.delete(draft, False)

    def _commit(self, manifest: DataFrame, base: int) -> int:
        name = uuid.uuid4().hex
        manifest.coalesce(1).write.parquet(f"{self.path}/manifests/{name}")
        self._publish(f"{self.path}/versions/{base + 1:010d}", name)
        return base + 1

    def _tier(self, size: int) -> int:
        """Tier 0 is a full shard; each further tier is smaller by the fan-in."""
        if size >= 0.75 * self.target:
            return 0
        tier, reach = 1, self.target / self.fan_in
        while size < reach and tier < 64:
            tier, reach = tier + 1, reach / self.fan_in
        return tier

    def _written(self, folder: str) -> DataFrame:
        """The shards of one write, by the files Spark's committer left."""
        fs, place = self._fs(folder)
        files = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(place)] if fs.exists(place) else []
        rows = [(f"{folder}/{name}", size, self._tier(size)) for name, size in files if name.endswith(".parquet")]
        return self.spark.createDataFrame(rows, _MANIFEST)

    def _folder(self) -> str:
        return f"{self.path}/data/{uuid.uuid4().hex}"

    def landed(self, rows: DataFrame, arrival: Column | None = None) -> list[str]:
        """Writes rows as shards that no version names yet: the folders of the arrivals, in the order of their numbers.

        One job writes all arrivals, a shard for each of its tasks and arrivals.
        """
        base = self._folder()
        (column,) = fresh(self.schema.names, "arrival")
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema]
        if arrival is None:
            rows.select(*columns).write.parquet(base)
            return [base]
        rows.select(*columns, arrival.alias(column)).write.partitionBy(column).parquet(base)
        parts = [(int(name.split("=")[1]), name) for name in self._list(base) if name.startswith(f"{column}=")]
        return [f"{base}/{name}" for _, name in sorted(parts)]

    def admit(self, folder: str) -> int:
        """Commits the shards of a folder; the version."""
        new = self._written(folder)
        for _ in range(TRIES):
            base = self.version()
            try:
                return self._commit(self.manifest(base).unionByName(new), base)
            except Conflict:
                continue
        raise Conflict(f"{folder} is written, but others committed first {TRIES} times")

    def append(self, rows: DataFrame) -> int:
        """Writes an arrival as new shards, one for each of its partitions, and commits them; the version."""
        return self.admit(self.landed(rows)[0])

    def compact(self) -> int:
        """Merges each tier that has a run of shards, smallest first, until none has; the version after.

        The shards of a tier are read together and packed into files of about the
        target size. Nothing is shuffled: a task reads whole shards, one after
        another, and writes one file, so that a merge costs one read and one write
        of the tier, and each row is rewritten once for each tier it climbs. If
        others commit meanwhile, the merge is committed upon theirs, unless they
        have merged one of its shards: then it is dropped.
        """
        while True:
            live = self.manifest(self.version())
            tiers = live.where("tier > 0").groupBy("tier").agg(F.count("*").alias("n")).where(F.col("n") >= self.fan_in)
            chosen = tiers.agg(F.max("tier")).first()[0]
            if chosen is None:
                return self.version()
            run = live.where(F.col("tier") == chosen)
            parts, size = run.agg(F.sort_array(F.collect_list("shard")), F.sum("bytes")).first()  # names only, as Spark's own listing holds
            folder = self._folder()
            self.spark.read.schema(self.schema).parquet(*parts).coalesce(max(1, round(size / self.target))).write.parquet(folder)
            made = self._written(folder)
            # What stays below the target has climbed at least one tier, so that compaction ends.
            made = made.withColumn("tier", F.least("tier", F.lit(chosen - 1)))
            self._replace(parts, made)

    def _replace(self, parts: list[str], made: DataFrame) -> None:
        gone = self.spark.createDataFrame([(p,) for p in parts], "shard string")
        for _ in range(TRIES):
            base = self.version()
            live = self.manifest(base)
            if live.join(gone, "shard", "left_semi").count() < len(parts):
                return
            try:
                self._commit(live.join(gone, "shard", "left_anti").unionByName(made), base)
                return
            except Conflict:
                continue
        raise Conflict(f"others committed first {TRIES} times")

    def read(self, version: int | None = None, shard_col: str = "_shard") -> DataFrame:
        """The rows of a version, with the number of the shard each is in, from 0 by size and name order of its manifest.

        Before the first commit there are no rows, of the same columns.
        """
        version = self.version() if version is None else version
        names = [r[0] for r in self.manifest(version).orderBy(F.desc("bytes"), "shard").select("shard").collect()]
        if not names:
            return self.spark.createDataFrame([], self.schema).withColumn(shard_col, F.lit(0))
        # The last two parts of a path tell shards of one store apart.
        (file,) = fresh([*self.schema.names, shard_col], "file")
        tail = F.array_join(F.slice(F.split(F.input_file_name(), "/"), -2, 2), "/")
        rows = self.spark.read.schema(self.schema).parquet(*names).withColumn(file, tail)
        numbers = self.spark.createDataFrame([("/".join(s.split("/")[-2:]), i) for i, s in enumerate(names)], T.StructType([T.StructField(file, T.StringType()), T.StructField(shard_col, T.IntegerType())]))
        # A row for each shard, counted here; Spark does not know how few they are and would shuffle all texts on them.
        numbers = F.broadcast(numbers) if len(names) <= BROADCAST_SHARDS else numbers
        return rows.drop(shard_col).join(numbers, file).drop(file)

    def vacuum(self, retain: int = RETAIN, leftover_age: float = LEFTOVER_AGE) -> int:
        """Forgets all but the last versions and deletes the shards that only those named; how many.

        A shard that a writer has not committed yet has never been named, so it
        stays, until it is old enough to be a leftover of one that died. A
        version's file goes before its shards, so that no version that can be seen
        lacks one.
        """
        versions = self.versions()
        kept, old = versions[-max(retain, 1) :], versions[: -max(retain, 1)]
        named = {v: self._manifest_name(v) for v in versions}
        where = lambda some: [f"{self.path}/manifests/{named[v]}" for v in some]
        deleted = 0
        if old:
            was, live = (self.spark.read.schema(_MANIFEST).parquet(*where(v)).select("shard").distinct() for v in (old, kept))
            gone = [r[0] for r in was.join(live, "shard", "left_anti").collect()]
            for v in old:
                self._delete(f"{self.path}/versions/{v:010d}")
            deleted = sum(self._delete(shard) for shard in gone)
            for path in where(old):
                self._delete(path)
        return deleted + self._leftovers(kept, named, leftover_age)

    def _leftovers(self, kept: list[int], named: dict[int, str], age: float) -> int:
        """Deletes folders of data and manifests that are old and that no version names."""
        before = (time.time() - age) * 1000
        used = {named[v] for v in kept}
        if kept:
            shards = self.spark.read.schema(_MANIFEST).parquet(*[f"{self.path}/manifests/{named[v]}" for v in kept])
            at = F.element_at(F.split(F.element_at(F.split("shard", "/data/"), -1), "/"), 1)
            used |= {r[0] for r in shards.select(at).distinct().collect()}
        deleted = 0
        for kind in ("data", "manifests"):
            fs, place = self._fs(f"{self.path}/{kind}")
            for status in fs.listStatus(place) if fs.exists(place) else []:
                if status.getPath().getName() not in used and status.getModificationTime() < before:
                    deleted += self._delete(status.getPath().toString())
        return deleted


def sharded(df: DataFrame, store: ShardStore, arrivals: int, id_col: str = "doc_id", shard_col: str = "_shard") -> DataFrame:
    """All rows of df, brought in as so many arrivals, compacted after each fan-in of them, and read back.

    An arrival is a class of a hash of the id; all are written by one job and
    admitted one after another. Null ids and rows with one id stay together and
    are all kept; an empty table gives no rows; columns keep their names and types,
    and only shard_col is added (a column of that name is replaced).
    """
    folders = store.landed(df, F.pmod(F.xxhash64(id_col), F.lit(arrivals)))
    for i, folder in enumerate(folders, 1):
        store.admit(folder)
        if i % store.fan_in == 0 or i == len(folders):
            store.compact()
            store.vacuum()
    return store.read(shard_col=shard_col)

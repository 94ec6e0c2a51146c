"""What the operators share: tables, written intermediates and connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which every executor can reach.

    Where the setting is absent, a local master gets a folder of its own; on a
    cluster that is an error, since executors do not see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        key = context.applicationId
        if key not in _LOCAL:
            _LOCAL[key] = tempfile.mkdtemp(prefix="spark-")
        base = _LOCAL[key]
    return f"{base.rstrip('/')}/fragmill-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read again.

    This ends the lineage: a lost executor costs a re-read, not a recomputation
    of everything before. What was shuffled for it is deleted once it is written.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The partitions that explicit shuffles use: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hex16(value: Column) -> Column:
    """Sixteen lowercase hex digits of a 64-bit integer."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


#: What a Python worker keeps from one task to the next.
_KEPT: dict = {}


def kept(key, build):
    """What build() gives, kept in this Python worker until another key is asked for: what stages keep does not add up."""
    if key not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[key] = build()
    return _KEPT[key]


def give_back() -> None:
    """Returns freed memory to the system: a worker outlives its stage, and allocators hold on to what the stage used."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it new among columns, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def discard(df: DataFrame) -> None:
    """Deletes what cut() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: A key with more than one in so many rows is dealt to many tasks: fewer keys than that can be so frequent.
HOT = 1000


def joined(rows: DataFrame, small: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """rows joined to small, which has one row for each key and in n how often rows hold it; n itself is left out.

    Keys that hold more than a thousandth of all rows are fewer than a thousand,
    and only they are broadcast, as a list: their rows are dealt to all partitions
    by number, and their row of small stands in each. So no key fills a task,
    rows are read once, and none is left out. Null keys match nothing.
    """
    salt, hot = fresh([*rows.columns, *small.columns], "salt", "hot")
    total = small.agg(F.sum(n)).first()[0] or 0
    often = F.col(n) * HOT > total
    places = F.sequence(F.lit(0), F.lit(partitions(rows.sparkSession) - 1))
    listed = F.broadcast(small.where(often).select(*keys, F.lit(True).alias(hot)))
    left = rows.join(listed, keys, "left")
    left = left.withColumn(salt, F.when(F.col(hot), F.pmod(F.monotonically_increasing_id(), F.lit(partitions(rows.sparkSession)))).otherwise(0).cast("int")).drop(hot)
    right = small.withColumn(salt, F.explode(F.when(often, places).otherwise(F.array(F.lit(0))))).drop(n)
    return left.join(right, [*keys, salt]).drop(salt)


#: Tasks that a node's links are dealt to, at most.
SALTS = 64


def _with_least(links: DataFrame) -> DataFrame:
    """links (a, b) with m, the least b of each a; a hub's links are dealt to many tasks by a hash of b."""
    dealt = links.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    parts = dealt.groupBy("a", "s").agg(F.min("b").alias("m"))
    least = parts.groupBy("a").agg(F.min("m").alias("m"), F.collect_list("s").alias("s"))
    return dealt.join(least.withColumn("s", F.explode("s")), ["a", "s"]).select("a", "b", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node reachable.

    edges: (a, b) of one orderable type, in any order and number. Large-star and
    small-star rounds alternate: each node links its neighbours to the smallest
    of them, until no link changes. The edge set never grows, a hub's links are
    spread over many tasks, and every round is written to the shared folder in
    place of the one before. Self-links and nulls are ignored; no edges give no
    rows.
    """
    links = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    links, before = cut(links), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        large = _with_least(links.union(links.select("b", "a"))).where("b > a")
        large = large.select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        small = _with_least(large)
        # A node's link to its own least stays; its other neighbours are linked to that.
        small = small.select(F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b")).distinct()
        after = cut(small)
        discard(links)
        links = after

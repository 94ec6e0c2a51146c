"""Embedding near-duplicates: binary codes of rotated vectors bound each cosine, and only pairs in doubt are computed."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, cut, discard, joined, partitions
from .simhash import contracted

SEED = 42
THRESHOLD = 0.98
#: Chance that a pair right at the threshold shares no bucket; above it the chance is smaller.
MISS = 1e-9
#: Deviations by which an estimate may be off before a pair is ruled out: a chance of some 2 in a billion.
DOUBT = 6.0
#: Vectors of the largest label that a bucket holds if they are spread evenly.
BUCKET = 128
#: Vectors of a bucket that are compared with as many others in one step; larger buckets are cut into blocks.
BLOCK = 4096
#: Pairs computed exactly at a time.
PAIRS = 1 << 16


def padded(dim: int) -> int:
    """The power of two, 64 at least, that rotations of so many components work on."""
    return max(64, 1 << (dim - 1).bit_length())


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """The rows of x, padded with zeros, after the random rotation of that number: signs and a Hadamard transform, three times."""
    n, size = len(x), padded(x.shape[1])
    out = np.zeros((n, size), np.float32)
    out[:, : x.shape[1]] = x
    for signs in np.random.default_rng((SEED, number, size)).choice(np.float32([-1, 1]), (3, size)):
        out *= signs
        h = 1
        while h < size:
            halves = out.reshape(n, -1, 2, h)
            out = np.concatenate([halves[:, :, :1] + halves[:, :, 1:], halves[:, :, :1] - halves[:, :, 1:]], axis=2).reshape(n, size)
            h *= 2
        out = out / np.float32(math.sqrt(size))
    return out


def tables(bits: int, threshold: float, miss: float = MISS) -> int:
    """How many tables of so many sign bits leave a pair at the threshold without a common bucket at most that often."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if same >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def units(packed: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    x = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Codes:
    """How vectors are coded: tables of sign bits after random rotations, and the correction factor of the first rotation's code."""

    def __init__(self, bits: int, threshold: float):
        self.bits, self.threshold, self.n = bits, threshold, tables(bits, threshold)

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed sign bits of each unit vector, and its inner product with the vector its first code stands for."""
        size = padded(x.shape[1])
        turns = [rotated(x, i) for i in range(max(1, -(-self.bits * self.n // size)))]
        factor = np.abs(turns[0]).sum(axis=1, dtype=np.float64) / math.sqrt(size)
        return np.packbits(np.concatenate(turns, axis=1) > 0, axis=1), np.minimum(factor, 1.0)

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """The bucket of each code in each table."""
        signs = np.unpackbits(codes, axis=1, count=self.bits * self.n).reshape(len(codes), self.n, self.bits)
        return (signs.astype(np.int64) << np.arange(self.bits)).sum(axis=2) if self.bits else np.zeros((len(codes), 1), np.int64)

    def least(self, factor: np.ndarray, size: int) -> np.ndarray:
        """The inner product with a code below which a cosine is under the threshold.

        A vector at cosine t from o has with o's code the product factor x t plus a
        part along what the code adds to o; that part has mean zero, so product /
        factor is an unbiased estimate of t. It is at most rest x side, and over
        random rotations some 1 / sqrt(size - 1) of that.
        """
        rest, side = np.sqrt(1 - factor**2), math.sqrt(1 - self.threshold**2)
        return factor * self.threshold - rest * side * min(1.0, DOUBT / math.sqrt(size - 1)) - 1e-5

    def links(self, x: np.ndarray, codes: np.ndarray, factor: np.ndarray, side: np.ndarray, table: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows of all linked pairs of a cell that no earlier table has found: within it, or of side 0 with side 1."""
        within = bool(side[0] == 2)
        a, b = (np.arange(len(x)),) * 2 if within else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        size, keys = padded(x.shape[1]), self.keys(codes)
        turned = rotated(x[a], 0)
        signs = (np.unpackbits(codes[b, : size // 8], axis=1).astype(np.float32) * 2 - 1) / np.float32(math.sqrt(size))
        least = self.least(factor[b], size).astype(np.float32)
        for at in range(0, len(a), 512):
            doubt = turned[at : at + 512] @ signs.T >= least
            if within:
                doubt &= np.arange(len(b)) > np.arange(at, at + len(doubt))[:, None]
            i, j = np.nonzero(doubt)
            for k in range(0, len(i), PAIRS):
                p, q = a[i[k : k + PAIRS] + at], b[j[k : k + PAIRS]]
                near = np.einsum("ij,ij->i", x[p], x[q]) >= self.threshold
                p, q = p[near], q[near]
                new = ~(keys[p, :table] == keys[q, :table]).any(axis=1)
                yield p[new], q[new]


def _keyed(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, key, vector): SHA-256 and bytes of each vector that can link, both null for others."""
    element = getattr(df.schema[vector_col].dataType, "elementType", None)
    kind = "float" if isinstance(element, T.FloatType) else "double"
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("key", T.BinaryType()), T.StructField("vector", T.BinaryType())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = batch.column(1).is_valid().to_pylist(), batch.column(2)
            flat, ends, here = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy(), vectors.is_valid().to_pylist()
            # A zero's sign makes no other vector.
            flat = np.asarray(flat, "<f4" if kind == "float" else "<f8") + 0
            sound = np.isfinite(flat)
            packed = []
            for i in range(batch.num_rows):
                s = slice(ends[i], ends[i + 1])
                packed.append(flat[s].tobytes() if labels[i] and here[i] and sound[s].all() and flat[s].any() else None)
            keys = [p and hashlib.sha256(p).digest() for p in packed]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], names=["vec_id", "label", "key", "vector"])

    return rows.mapInArrow(keyed, schema)


def _coded(classes: DataFrame, how: Codes, kind: str) -> DataFrame:
    """classes with code and factor of each vector."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("vector").to_pylist()
            codes, factors = [b""] * len(packed), [0.0] * len(packed)
            order = sorted(range(len(packed)), key=lambda i: len(packed[i]))
            for _, same in groupby(order, key=lambda i: len(packed[i])):
                same = list(same)
                for k in range(0, len(same), 1000):
                    part = same[k : k + 1000]
                    code, factor = how.of(units([packed[i] for i in part], kind))
                    for i, c, f in zip(part, code, factor):
                        codes[i], factors[i] = c.tobytes(), float(f)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(factors)], names=[*batch.schema.names, "code", "factor"])

    return classes.mapInArrow(coded, T.StructType([*classes.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("factor", T.DoubleType())]))


def _placed(rows: DataFrame, how: Codes) -> DataFrame:
    """rows, each once for every table, with the table and the bucket of its code."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                keys = [how.keys(np.frombuffer(c, np.uint8)[None])[0] for c in batch.column("code").to_pylist()]
                each = pa.array(np.repeat(np.arange(len(keys)), how.n))
                places = [pa.array(np.tile(np.arange(how.n, dtype=np.int32), len(keys))), pa.array(np.concatenate(keys))]
                yield pa.RecordBatch.from_arrays([*batch.take(each).columns, *places], names=[*batch.schema.names, "t", "bucket"])

    return rows.mapInArrow(placed, T.StructType([*rows.schema.fields, T.StructField("t", T.IntegerType()), T.StructField("bucket", T.LongType())]))


_CELL = ["label", "dim", "t", "bucket", "i", "j"]


def _linked(rows: DataFrame, how: Codes, kind: str) -> DataFrame:
    """(a, b, w) of cells: a and its smallest partner b in the cell's links, or null and how many vectors a links to."""

    def cell(t: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        cid, n, side, code, factor, vector = zip(*held)
        cid, n, side = np.array(cid), np.array(n), np.array(side)
        if len(cid) < 2 or side[0] != 2 and (side == side[0]).all():
            return
        codes = np.frombuffer(b"".join(code), np.uint8).reshape(len(code), -1)
        w, ends = np.zeros(len(cid), np.int64), [(cid[:0], cid[:0])]
        for p, q in how.links(units(vector, kind), codes, np.array(factor), side, t):
            np.add.at(w, p, n[q])
            np.add.at(w, q, n[p])
            if len(p):
                ends.append(contracted(cid[p], cid[q]))
        a, b = (np.concatenate(x) for x in zip(*ends))
        if len(a):
            a, b = contracted(a, b)
            some = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([a, cid[some]])), pa.array([*b.tolist(), *[None] * len(some)], pa.int64()), pa.array(np.concatenate([np.zeros(len(a), np.int64), w[some]]))],
                names=["a", "b", "w"],
            )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for k, group in groupby(zip(*columns), key=lambda r: r[: len(_CELL)]):
                if k != key:
                    if held:
                        yield from cell(key[2], held)
                    key, held = k, []
                held += [r[len(_CELL) :] for r in group]
        if held:
            yield from cell(key[2], held)

    rows = rows.select(*_CELL, "cid", "n", "side", "code", "factor", "vector")
    rows = rows.repartition(partitions(rows.sparkSession), *_CELL).sortWithinPartitions(*_CELL, "cid")
    return rows.mapInArrow(linked, "a long, b long, w long")


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, n_links, component_id, kept) of every row.

    Rows of one label and length whose cosine, in double precision, is at least the
    threshold are linked. Equal vectors are one class, so copies cost a row each and
    no pairs. Classes meet in tables of sign bits of randomly rotated vectors, as
    many as leave a pair at the threshold apart once in 10^9; the number of bits
    grows with the logarithm of the largest label. In a bucket the product of a
    vector with another's binary code, corrected by the stored factor, bounds their
    cosine, and only pairs that the bound leaves open are computed. A pair counts in
    the first table where it meets; tasks give sums and trees of links, never
    pairs. A bucket above BLOCK is cut into blocks, and each pair of blocks is a
    cell of its own: each row is sent to as many cells as there are blocks.

    Vectors that are null, empty, zero or hold a null or non-finite component, and
    rows with a null label, link with nothing and are their own component. Rows with
    one id stay separate rows. A null id never names a component unless all its
    members' ids are null. Other columns are not read; no rows give no rows.
    """
    kind = "<f4" if isinstance(getattr(df.schema[vector_col].dataType, "elementType", None), T.FloatType) else "<f8"
    rows = _keyed(df, id_col, vector_col, label_col)
    classes = rows.where("key is not null").groupBy("label", "key").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.length("vector")))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    how = Codes(min(60, max(0, math.ceil(math.log2(largest / BUCKET)))), threshold)
    coded = cut(_coded(classes.select("label", "dim", "cid", "n", "vector"), how, kind))
    bucket = ["label", "dim", "t", "bucket"]
    large = _placed(coded.select("label", "dim", "code"), how).groupBy(*bucket).count().where(F.col("count") > BLOCK)
    placed = _placed(coded, how).join(large, bucket, "left")
    blocks = F.ceil(F.coalesce("count", F.lit(1)) / BLOCK).cast("int")
    placed = placed.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select(
        *bucket, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cid", "n", "code", "factor", "vector",
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    found = cut(_linked(cells, how, kind))
    sums = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("w").alias("w"))
    roots = components(found.where("b is not null")).withColumnRenamed("node", "cid")
    rooted = cut(
        classes.select("cid", "label", "key", "first_id", "n").join(sums, "cid", "left").join(roots, "cid", "left")
        .select("label", "key", "first_id", "n", F.coalesce("w", F.lit(0)).alias("w"), F.coalesce("root", "cid").alias("root"))
    )
    named = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members")))
    labels = cut(joined(rooted, named, ["root"], "members").select("label", "key", "n", (F.col("w") + F.col("n") - 1).alias("n_links"), "component_id"))
    for done in (coded, found):
        discard(done)
    rows = rows.drop("vector")
    linked = joined(rows.where("key is not null"), labels, ["label", "key"])
    alone = rows.where("key is null").select("vec_id", "label", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "label", "n_links", "component_id").unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

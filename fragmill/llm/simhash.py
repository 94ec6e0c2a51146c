"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, hex16, joined, partitions

SEED = 42
RADIUS = 3
BLOCKS = RADIUS + 1
WIDTH = 64 // BLOCKS
KEPT = 64 - WIDTH
#: Rows of a sorted partition that are linked at a time.
CHUNK = 400_000


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of so many words, repeats included; all words if there are fewer."""
    if not text:
        return np.empty(0, np.uint64)
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < words:
        shingles, n = [b" ".join(found)], 1
    else:
        shingles, n = map(b" ".join, zip(*(found[i:] for i in range(words)))), len(found) - words + 1
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if over half of the hashes set it; no hashes give zero. Signed, as Spark's long."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of every whole text, as a signed long.

    Words are runs of anything but ASCII white space, after A-Z are lower-cased.
    Null, empty and blank texts have the fingerprint zero.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(shingle_hashes(text.as_py(), words)) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, fp long")


def _shifts(block: int) -> tuple[int, np.uint64]:
    """Of a block: where it begins, and the mask of its bits."""
    return block * WIDTH, np.uint64((1 << WIDTH) - 1)


def _without(fps: np.ndarray, block: int) -> np.ndarray:
    """The 48 bits that are left without the block, its number above them."""
    at, _ = _shifts(block)
    low = fps & np.uint64((1 << at) - 1)
    high = (fps >> np.uint64(at + WIDTH)) << np.uint64(at) if at + WIDTH < 64 else np.zeros_like(fps)
    return low | high | (np.uint64(block) << np.uint64(KEPT))


def ball_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp): for each dropped block, the rest of the fingerprint and all that differ from it in one bit."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(KEPT, dtype=np.uint64)]).astype(np.uint64)
    for batch in batches:
        fps = np.asarray(batch.column(0)).view(np.uint64)
        for i in range(0, len(fps), 256):
            part = fps[i : i + 256]
            keys = np.concatenate([(_without(part, b)[:, None] ^ flips).ravel() for b in range(BLOCKS)])
            own = np.tile(np.repeat(part, len(flips)), BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(own.view(np.int64))], names=["key", "fp"]
            )


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links a-b with each node linked to the smallest (as signed) of its component instead."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            keep = label != np.arange(len(nodes))
            return nodes[keep], nodes[label[keep]]
        label = after


def _linked(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the fingerprints of each key as all their pairs within the radius would.

    Two fingerprints that meet at a key differ from it in one kept bit at most,
    so in two from each other; with at most one bit of the dropped block they are
    within the radius. Those that have the kept bits themselves may differ in all
    three bits of the block: they stand also under each neighbour of their own
    block's value, where two of them meet again in the middle.
    """
    same = np.concatenate([[False], keys[1:] == keys[:-1], [False]])
    many = same[1:] | same[:-1] if len(keys) else np.zeros(0, bool)
    keys, fps = keys[many], fps[many]
    if not len(keys):
        return fps, fps
    block = (keys.view(np.uint64) >> np.uint64(KEPT)).astype(np.int64)
    group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    u = fps.view(np.uint64)
    x = ((u >> (block * WIDTH).astype(np.uint64)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
    own = np.zeros(len(u), bool)
    for b in range(BLOCKS):
        of = block == b
        own[of] = _without(u[of], b) == keys[of].view(np.uint64)
    flips = 1 << np.arange(WIDTH)
    code = np.concatenate([(group << WIDTH) | x, (((group[own] << WIDTH) | x[own])[:, None] ^ flips).ravel()])
    who = np.concatenate([fps, np.repeat(fps[own], WIDTH)])
    order = np.lexsort((who, code))
    code, who = code[order], who[order]
    first = np.concatenate([[True], code[1:] != code[:-1]])
    codes, leads = code[first], who[first]
    ends = [(who, leads[np.cumsum(first) - 1])]
    for flip in flips:
        up = codes[(codes & flip) == 0] | flip
        at = np.searchsorted(codes, up)
        hit = (at < len(codes)) & (codes[np.minimum(at, len(codes) - 1)] == up)
        ends.append((leads[(codes & flip) == 0][hit], leads[at[hit]]))
    a, b = (np.concatenate(x) for x in zip(*ends))
    apart = a != b
    return _verified(a[apart], b[apart])


def _verified(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are within the radius."""
    near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= RADIUS
    return a[near], b[near]


def ball_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a partition that is sorted by key; groups that batches split are put together again."""
    held_keys, held_fps = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def linked(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = _linked(keys, fps)
        if len(a):
            a, b = contracted(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    n = 0
    for batch in batches:
        held_keys.append(np.asarray(batch.column(0)))
        held_fps.append(np.asarray(batch.column(1)))
        n += batch.num_rows
        if n >= CHUNK:
            keys, fps = np.concatenate(held_keys), np.concatenate(held_fps)
            last = np.searchsorted(keys, keys[-1])
            yield from linked(keys[:last], fps[:last])
            held_keys, held_fps, n = [keys[last:]], [fps[last:]], 0
    yield from linked(np.concatenate(held_keys), np.concatenate(held_fps))


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of a column fp that connect all pairs within three bits.

    Each fingerprint emits, for each of four blocks dropped, the 49 values that
    differ from the rest in one bit at most: half the radius that is left, as a
    pair at three bits has a block with one of them. 196 rows a fingerprint,
    however large the table, and no group makes a pair for each two members: a
    key has 49 x 65,536 fingerprints at most, and they are linked in a chain.
    """
    n = partitions(distinct.sparkSession)
    rows = distinct.select("fp").repartition(n, "fp").mapInArrow(ball_variants, "key long, fp long")
    return rows.repartition(n, "key").sortWithinPartitions("key").mapInArrow(ball_links, "a long, b long")


def ball_components(distinct: DataFrame) -> DataFrame:
    """(fp, n, first) of different fingerprints, first being the smallest of all that links within three bits reach."""
    distinct = cut(distinct)
    roots = components(near_links(distinct))
    rooted = cut(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root")))
    named = cut(rooted.groupBy("root").agg(F.min("first").alias("_first"), F.count("*").alias("_fps")))
    return cut(joined(rooted.select("fp", "n", "root"), named, ["root"], "_fps").select("fp", "n", F.col("_first").alias("first")))


def simhash_groups(df: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) of every row.

    Fingerprints that differ in three bits or fewer are linked, and component_id
    is the smallest id that links reach. Null and blank texts share the
    fingerprint zero and are linked like any other. Repeated rows stay; a null id
    never names a component unless all its members' ids are null. Other columns
    are not read; no rows give no rows.
    """
    docs = cut(fingerprints(df, words, id_col, text_col))
    distinct = docs.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    labels = ball_components(distinct).withColumnRenamed("first", "component_id")
    return joined(docs, labels, ["fp"]).select("doc_id", "fp", hex16(F.col("fp")).alias("fingerprint"), "component_id")

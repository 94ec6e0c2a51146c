"""Near-duplicates by a similarity of shingle sets: balls around SimHashes and SimHashes of samples link most, an exact join on rare shingles the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, discard, fresh, joined, partitions
from .simhash import ball_components, shingle_hashes, simhash

WORDS, SIMILARITY = 5, 0.8
#: A shingle set has a least hash in each bin; each band of bins is a sample with a SimHash of its own.
BINS, BAND = 48, 4
BANDS = BINS // BAND
#: Standard deviations by which the likeness of two sets of least hashes may fall short before a pair is not compared.
SLACK = 5.0
#: Shingles ranked as frequent, of one text in so many; they come last in every prefix, and any ranking gives the same links.
FREQUENT, SAMPLE = 100_000, 16
#: 64-bit words of a set's parities, and the classes with one shingle that a task joins at a time.
PARITIES, SALT = 8, 500
#: Keeps rounding from raising the shingles that a pair must share.
_EPSILON = 1e-9

_KEYS = pa.schema(
    [("doc_id", pa.int64()), ("body", pa.int64()), ("fp", pa.int64()), ("same", pa.binary()), ("n", pa.int32()), ("least", pa.binary()), ("fps", pa.list_(pa.int64()))]
    + [("rare", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))]
)
_KEYS_DDL = "doc_id long, body long, fp long, same binary, n int, least binary, fps array<long>, rare array<long>, bits array<long>"
_PAIR = "a struct<doc_id:long,body:long>, b struct<doc_id:long,body:long>"


def sampled(hashes: np.ndarray) -> tuple[bytes, int, bytes, list[int | None]]:
    """Of shingles: a hash of their set, its size, 16 bits of each bin's least hash (0: none), and the SimHash of each band."""
    found = np.unique(hashes)
    bins, first = np.unique(found % np.uint64(BINS), return_index=True)
    at = bins.astype(np.int64)
    least = np.zeros(BINS, np.uint64)
    least[at] = found[first]
    mixed = least * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    some = np.zeros(BINS, bool)
    some[at] = True
    short = np.where(some, (mixed >> np.uint64(40)) % np.uint64(65535) + np.uint64(1), 0).astype(np.uint16)
    bits = np.unpackbits(mixed.view(np.uint8).reshape(BINS, 8), axis=1, bitorder="little") * some[:, None]
    counts = bits.reshape(BANDS, BAND, 64).sum(axis=1)
    sizes = some.reshape(BANDS, BAND).sum(axis=1)
    fps = np.packbits(counts * 2 > sizes[:, None], axis=1, bitorder="little").view("<i8")[:, 0]
    return xxhash.xxh3_128_digest(found.tobytes()), len(found), short.tobytes(), [int(f) if s else None for f, s in zip(fps, sizes)]


def rarest(hashes: np.ndarray, similarity: float, frequent: np.ndarray, ranks: np.ndarray) -> tuple[list[int], list[int]]:
    """Of shingles: so many of the rarest that a similar set has one of them too, and the parities of the set.

    frequent is sorted, with the rank of each; other shingles come before them,
    by hash. A pair differs in as many shingles as its parities do, at least.
    """
    found = np.unique(hashes)
    size = len(found) - int(np.ceil(similarity * len(found) - _EPSILON)) + 1
    place = np.bincount((found >> np.uint64(55)).astype(np.int64), minlength=64 * PARITIES) & 1
    bits = np.packbits(place.astype(np.uint8), bitorder="little").view("<i8").tolist()
    if len(frequent) and len(found):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        found = found[np.argsort(np.where(frequent[at] == found, ranks[at], 0), kind="stable")]
    return found[:size].view(np.int64).tolist(), bits


def likely(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets with these least hashes, a row each, may be so similar."""
    either = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    slack = SLACK * np.sqrt(similarity * (1 - similarity) / np.maximum(either, 1))
    return (either == 0) | (equal >= (similarity - slack) * either)


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample of the texts, sorted, and their counts."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(shingle_hashes(text.as_py(), words)).view(np.int64))], names=["shingle"])

    some = docs.where(F.pmod("body", F.lit(SAMPLE)) == 0).select("text").mapInArrow(shingles, "shingle long")
    counts = some.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    top = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    found, n = (np.asarray(top.column(i).combine_chunks()) for i in (0, 1))
    order = np.argsort(found.view(np.uint64))
    return found.view(np.uint64)[order], n[order]


def _sides(kinds: DataFrame, roots: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """What meets in rare_pairs, (shingle, part, x) and (shingle, part, y), and what was written for it.

    Of two similar sets the smaller has their first common shingle among so few of
    its rarest as a set of its own size would need, the larger among as many as its
    smallest partner needs. x has the first kind of places only, so that texts with
    one template and too little else in common do not meet at the template, as
    their own shingles fill these places.
    """
    where = roots.select(F.col("node").alias("_n"), F.xxhash64("root").alias("_r"))
    placed = kinds.join(where, F.col("node") == F.col("_n"), "left")
    placed = cut(placed.select("node", "kind", "n", "rare", "bits", F.coalesce("_r", F.xxhash64("node")).alias("root")))
    posts = placed.select("kind", "root", "n", F.posexplode("rare").alias("at", "shingle"))
    first = F.col("n") - F.col("at") >= F.ceil(F.lit(2 * similarity / (1 + similarity)) * F.col("n") - _EPSILON)
    posts = posts.withColumn("first", first).drop("n")
    apart = posts.groupBy("shingle").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.count_if("first").alias("_size"))
    apart = apart.where("_low <> _high and _size > 0").select("shingle", F.ceil(F.col("_size") / SALT).cast("int").alias("parts"))
    live = cut(posts.drop("root").join(apart, "shingle").join(placed.select("node", "kind", "n", "bits", "root"), "kind"))

    def side(rows: DataFrame, name: str, part) -> DataFrame:
        return rows.select("shingle", part.alias("part"), F.struct("node", "kind", "n", "bits", "root", "at").alias(name))

    x = side(live.where("first"), "x", F.pmod(F.xxhash64("kind"), F.col("parts")).cast("int"))
    return x, side(live, "y", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), [placed, live]


def rare_pairs(kinds: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(a, b): a superset of all similar pairs of classes that have different roots.

    kinds: (node, kind, n, rare, bits), kind a number of its own; roots: (node, root).
    Sets with a Jaccard similarity share a number of shingles that their sizes
    give, so the first that they share, in one order for all, stands among as many
    of each as this leaves over. Classes meet at those, the smaller at fewer of its
    own (see _sides); places, sizes and parities then drop only pairs that cannot
    be similar. Shingles whose classes have one root already are left out, and
    those of many classes are joined in parts.
    """
    x, y, written = _sides(kinds, roots, similarity)
    n, m = F.col("x.n"), F.col("y.n")
    shared = F.ceil(F.lit(similarity / (1 + similarity)) * (n + m) - _EPSILON)
    differ = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(PARITIES)), F.lit(0))
    fits = ((n < m) | ((n == m) & (F.col("x.kind") < F.col("y.kind")))) & (F.col("x.root") != F.col("y.root"))
    fits &= (n - F.col("x.at") >= shared) & (m - F.col("y.at") >= shared) & (differ <= n + m - 2 * shared)
    fits &= n >= similarity * m
    pairs = cut(x.join(y, ["shingle", "part"]).where(fits).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    for done in written:
        discard(done)
    return pairs


def ball_met(kinds: DataFrame) -> DataFrame:
    """(node, n, lead) of every class: lead is the (node, n) of the smallest whose SimHash links within three bits reach.

    kinds: (node, n, fp), fp the SimHash of a whole text. Fingerprints meet by
    half-radius balls, as those of simhash_groups do.
    """
    points = kinds.select("fp", "node", "n")
    leads = points.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("n"))
    leads = ball_components(leads).select("fp", F.col("n").alias("size"), F.col("first").alias("lead"))
    return cut(joined(points, leads, ["fp"], "size").select("node", "n", "lead"))


def near_duplicates(
    df: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, body, group_id, kept) of every different document: body is a hash of its text.

    Documents are linked if the sets of their shingles of so many words have at
    least the given Jaccard similarity; group_id is the smallest id that links
    reach, and the document kept is the group's smallest by (id, body).

    Equal sets are one class by a 128-bit hash. Classes meet by the balls around
    the SimHash of a whole text (ball_met), and at equal SimHashes of each of
    twelve samples of their shingles and of neighbouring samples together. Each
    member of a component or bucket is compared with its first only, so none makes
    pairs, and pairs whose least hashes are unlike are not compared at once. An
    exact join (rare_pairs) then compares all that these links leave apart, so that
    none is lost. A pair's similarity is computed from both whole texts.

    Texts with fewer words have one shingle, and those with none (null, empty,
    blank) are alike. Null ids come first. Rows that repeat id and text are one
    document. Other columns are not read; no rows give no rows.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [shingle_hashes(t.as_py(), words) for t in batch.column(2)]
            rows = [(simhash(h), *sampled(h), *rarest(h, similarity, frequent, ranks)) for h in hashes]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_KEYS)[2:])]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=_KEYS)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BINS) for i in (2, 3))
            keep = pa.array(likely(a, b, similarity))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.unique(shingle_hashes(t.as_py(), words)) for t in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    frequent, ranks = _frequent(docs, words)
    keys = cut(docs.mapInArrow(keyed, _KEYS_DDL))
    node = F.struct("doc_id", "body")
    of_all = [F.first(c).alias(c) for c in ("n", "least", "fps", "rare", "bits")]
    own = F.min_by("fp", node).alias("fp")
    kinds = cut(keys.groupBy("same").agg(F.min(node).alias("node"), own, *of_all).withColumn("kind", F.monotonically_increasing_id()))
    near = ball_met(kinds)
    after = F.concat(F.slice("fps", 2, BANDS), F.slice("fps", 1, 1))
    together = F.zip_with("fps", after, lambda x, y: F.when(x.isNotNull() & y.isNotNull(), F.xxhash64(x, y)))
    # Dealt anew, as few tasks have written the classes and each gives many rows here.
    dealt = kinds.select("node", "n", F.concat("fps", together).alias("fps")).repartition(partitions(df.sparkSession), "node")
    spots = cut(dealt.select("node", "n", F.posexplode("fps").alias("band", "fp")).where("fp is not null"))
    leads = spots.groupBy("band", "fp").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("size")).where("size > 1")
    met = joined(spots, cut(leads), ["band", "fp"], "size").select("node", "n", "lead").union(near)
    fair = F.least("n", "lead.n") >= similarity * F.greatest("n", "lead.n")
    met = met.where((F.col("node") > F.col("lead.node")) & fair)
    met = cut(met.select(F.col("node").alias("a"), F.col("lead.node").alias("b")).distinct())
    for done in (spots, near):
        discard(done)
    for end, out in (("a", "least"), ("b", "other")):
        often = met.groupBy(end).agg(F.count("*").alias("n"))
        # Written, as joined() deals out rows by their place and the rows of a join have none that lasts.
        met = cut(joined(met, cut(often.join(kinds.select(F.col("node").alias(end), F.col("least").alias(out)), end)), [end]))

    def whole(pairs: DataFrame) -> DataFrame:
        """The pairs whose whole texts are similar."""
        sides = pairs.select("a", "b", F.explode(F.array(F.struct(F.lit(0).alias("s"), F.col("a").alias("k")), F.struct(F.lit(1).alias("s"), F.col("b").alias("k")))).alias("x"))
        sides = sides.select("a", "b", F.col("x.s").alias("s"), F.coalesce("x.k.doc_id", F.lit(0)).alias("i"), F.col("x.k.doc_id").isNull().alias("none"), F.col("x.k.body").alias("body"))
        # Written, so that their size says how they are joined: few are sent to the texts, many meet them by a shuffle.
        often = cut(sides.groupBy("i", "none", "body").agg(F.count("*").alias("n")))
        held = docs.select(F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("none"), "body", "text")
        # One text of those that repeat id and text; the text of a document in many pairs is sent to many tasks.
        held = cut(held.join(often, ["i", "none", "body"]).dropDuplicates(["i", "none", "body"]))
        texts = joined(sides, held, ["i", "none", "body"])
        both = texts.groupBy("a", "b").agg(F.max(F.when(F.col("s") == 0, F.col("text"))).alias("x"), F.max(F.when(F.col("s") == 1, F.col("text"))).alias("y"))
        links = cut(both.mapInArrow(similar, _PAIR))
        for done in (held, often, pairs):
            discard(done)
        return links

    roots = components(whole(cut(met.select("a", "b", "least", "other").mapInArrow(alike, _PAIR))))
    more = whole(rare_pairs(kinds, roots, similarity))
    if not more.isEmpty():
        roots = components(roots.toDF("a", "b").union(more))
    top = kinds.select("same", "node").join(roots.withColumnRenamed("node", "_n").withColumnRenamed("root", "_r"), F.col("node") == F.col("_n"), "left")
    top = top.select("same", F.coalesce("_r", "node").alias("root"))
    named = keys.select("doc_id", "body", "same").distinct().join(top, "same")
    return named.select("doc_id", "body", F.col("root.doc_id").alias("group_id"), (node == F.col("root")).alias("kept"))


def one_of_each(df: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of df that near_duplicates keeps, one for each group."""
    number, body, key = fresh(df.columns, "number", "body", "key")
    kept = near_duplicates(df, words, similarity, id_col, text_col).where("kept").select(F.col("doc_id").alias(number), F.col("body").alias(body))
    rows = df.withColumn(key, F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    match = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(number)) & (F.col(key) == F.col(body))
    return rows.join(kept, match).dropDuplicates([id_col, key]).select(*[F.col(f"`{c}`") for c in df.columns])

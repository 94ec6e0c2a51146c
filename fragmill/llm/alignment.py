"""Two tokenizers' tokens of one text, aligned where both end, and how often each pair is linked in the corpus."""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, discard, joined, kept, partitions

#: Where a text can be cut: at a space alone between two characters that are none. Neither tokenizer has a token across.
CUTS = re.compile(r"(?<=\S)(?= \S)")
#: Pieces of texts that are looked at in one turn, each different one once, and pieces encoded together.
TURN, TOGETHER = 1_000_000, 3_000
#: Different pairs that a task counts before it hands counts on.
COUNTED = 200_000
#: Keys of a part of the hash, on average.
PART = 4096
#: Vectors that are added up at a time.
FAN = 64
#: Up to so many distinct pairs, some 20 bytes each, are broadcast; beyond, links and counts are joined.
BROADCAST_PAIRS = 4_000_000
_SHIFT = 20
_MASK = (1 << _SHIFT) - 1


def _bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: itself if printable, else letters from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the alignment of pieces of text.

    byte_json is the content of a byte-level BPE file whose merges make ids in
    order; piece_model that of a piece model with byte fallback that puts a space
    before a text; pattern cuts texts for the byte-level one.
    """

    def __init__(self, byte_json: str, piece_model: bytes, pattern: str):
        import sentencepiece
        import tiktoken

        model, letters = json.loads(byte_json)["model"], _bytes_of_letters()
        special = {t["content"] for t in json.loads(byte_json)["added_tokens"]}
        self.a_bytes = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"][x + y] != 256 + i for i, (x, y) in enumerate(merges)):
            raise ValueError("the merges do not make ids in order")
        self.a = tiktoken.Encoding("aligned", pat_str=pattern, mergeable_ranks={b: i for i, b in self.a_bytes.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if min(map(len, [*self.a_bytes.values(), *self.b_bytes])) == 0:
            raise ValueError("a token without bytes")
        if any("▁" in p.lstrip("▁") for p in pieces) or max(self.a_bytes) >= 1 << _SHIFT or len(pieces) >= 1 << _SHIFT:
            raise ValueError("the piece model has a piece with a space inside, or ids are too large")
        self.a_size = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        # Each id as text within a group, and as its last of A or B.
        self.a_text = np.array([[f"{i}{sign}" for i in range(len(self.a_size))] for sign in ",|"], object)
        self.b_text = np.array([[f"{i}{sign}" for i in range(len(self.b_size))] for sign in ",;"], object)

    def pieces(self, text: str) -> list[str]:
        """A space and the text, cut where no token of either kind goes across."""
        return CUTS.split(" " + text)

    def of(self, pieces: Iterable[str], texts: bool = True) -> Aligned:
        """The alignment of different pieces.

        Pieces that begin with a space alone and end with none are joined and
        encoded many at once, as no token goes across; the others come one by one.
        """
        inner, outer = [], []
        for p in pieces:
            (inner if p[1:2].strip() and p[-1].strip() else outer).append(p)
        parts = [inner[at : at + TOGETHER] for at in range(0, len(inner), TOGETHER)] + [[p] for p in outer]
        found = [x for part in parts for x in self._aligned(part, texts)] or self._aligned([], texts)
        return Aligned(inner + outer, *(np.concatenate(x) for x in list(zip(*found))[:5]), [t for x in found for t in x[5]])

    def _aligned(self, pieces: list[str], texts: bool) -> list[tuple]:
        """(whether bytes are given back, n_a, n_b, n, codes, texts) of pieces that are encoded together."""
        whole, raw = "".join(pieces), [p.encode("utf-8", "surrogatepass") for p in pieces]
        a, b = self.a.encode_ordinary(whole), self.b.encode(whole[1:], num_threads=1) if whole else []
        if not b"".join(raw) == b"".join([self.a_bytes[i] for i in a]) == b"".join([self.b_bytes[i] for i in b]):
            if len(pieces) > 1:
                return [x for p in pieces for x in self._aligned([p], texts)]
            return [(np.zeros(1, bool), *np.zeros((3, 1), np.int64), np.empty(0, np.int64), [""])]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end, ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum([len(x) for x in raw], dtype=np.int64)
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        a_last, b_last = np.diff(a_group, append=len(cuts)) > 0, np.diff(b_group, append=len(cuts)) > 0
        n_a, n_b, n = (np.searchsorted(x, ends, side="right") for x in (a_end, b_end, cuts))
        words = []
        if texts:
            order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
            each = np.concatenate([self.a_text[a_last.astype(int), a], self.b_text[b_last.astype(int), b]])[order].tolist()
            upto = [0, *(n_a + n_b).tolist()]
            words = ["".join(each[i:j]) for i, j in zip(upto, upto[1:])]
        return [(np.ones(len(pieces), bool), *(np.diff(x, prepend=0) for x in (n_a, n_b, n)), a[a_last] << _SHIFT | b[b_last], words)]


@dataclass
class Aligned:
    """Of each piece: whether both vocabularies give its bytes back, its tokens and links, and its groups as text with a last ';'; codes has the links of all."""

    pieces: list[str]
    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n: np.ndarray
    codes: np.ndarray
    texts: list[str]

    def codes_of(self, at: np.ndarray) -> np.ndarray:
        """The links of the pieces at these places, one after another."""
        n = self.n[at]
        return self.codes[np.repeat(np.cumsum(self.n)[at] - np.cumsum(n), n) + np.arange(n.sum())]


def mixed_bits(x: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """64 well mixed bits of each key under a seed."""
    x = x.astype(np.uint64) + (np.asarray(seed).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = 1 << 40


class PerfectHash:
    """A minimal perfect hash of distinct keys: each has a place of its own from 0 to their number less one.

    Keys fall into buckets of four on average. From the largest bucket on, a seed
    is searched that sends all keys of a bucket to free places; a bucket of one key
    stores its place itself, as a negative number. keys has them by place, so that
    a lookup can be verified.
    """

    def __init__(self, seeds: np.ndarray, keys: np.ndarray):
        self.seeds, self.keys = seeds, keys

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        n = len(keys)
        seeds, places = np.zeros(-(-n // 4), np.int64), np.full(n, -1, np.int64)
        bucket = (mixed_bits(keys, _SEEDS) % np.uint64(max(1, len(seeds)))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(len(seeds) + 1))
        sizes, free = np.diff(starts), np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            own = order[starts[b] : starts[b + 1]]
            first = 0
            while True:
                tried = np.arange(first, first + 64)
                at = (mixed_bits(keys[own][None], tried[:, None]) % np.uint64(n)).astype(np.int64)
                good = free[at].all(axis=1)
                for k in np.flatnonzero(good):
                    if len(set(at[k].tolist())) == len(own):
                        break
                else:
                    first += 64
                    continue
                seeds[b], places[own], free[at[k]] = first + k, at[k], False
                break
        single, left = np.flatnonzero(sizes == 1), np.flatnonzero(free)
        places[order[starts[single]]] = left
        seeds[single] = -1 - left
        by_place = np.empty(n, np.int64)
        by_place[places] = keys
        return cls(seeds, by_place)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it is none of the hash's."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        seeds = self.seeds[(mixed_bits(keys, _SEEDS) % np.uint64(len(self.seeds))).astype(np.int64)]
        at = np.where(seeds < 0, -1 - seeds, (mixed_bits(keys, np.maximum(seeds, 0)) % np.uint64(len(self.keys))).astype(np.int64))
        return np.where(self.keys[at] == keys, at, -1)


CHANGED = "a pair was not counted: the documents changed between the passes"


class PairCounts:
    """The parts of a perfect hash of all pairs behind one another, with each pair's count and whether it is its B id's highest.

    found has (seeds, keys, counts) of each part that has keys, out of so many parts.
    """

    def __init__(self, found: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int):
        seeds, keys, counts = zip(*(found.get(i, (np.empty(0, np.int64),) * 3) for i in range(parts)))
        self.seed_n, self.key_n = (np.array([len(x) for x in of], np.int64) for of in (seeds, keys))
        self.seed_at, self.key_at = (np.cumsum(n) - n for n in (self.seed_n, self.key_n))
        self.seeds, self.keys, self.counts = (np.concatenate(x) for x in (seeds, keys, counts))
        most = np.zeros(1 << _SHIFT, np.int64)
        np.maximum.at(most, self.keys & _MASK, self.counts)
        self.best = self.counts == most[self.keys & _MASK]

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, best) of each pair; the key that stands at its place must be the pair itself."""
        part = part_of(codes, len(self.key_n))
        if not self.key_n[part].all():
            raise KeyError(CHANGED)
        seeds = self.seeds[self.seed_at[part] + (mixed_bits(codes, _SEEDS) % self.seed_n[part].astype(np.uint64)).astype(np.int64)]
        at = np.where(seeds < 0, -1 - seeds, (mixed_bits(codes, np.maximum(seeds, 0)) % self.key_n[part].astype(np.uint64)).astype(np.int64))
        at += self.key_at[part]
        if not (self.keys[at] == codes).all():
            raise KeyError(CHANGED)
        return self.counts[at], self.best[at]


def part_of(codes: np.ndarray, parts: int) -> np.ndarray:
    return (mixed_bits(codes, _SEEDS + 1) % np.uint64(parts)).astype(np.int64)


def _in_turns(texts: pa.Array, aligner: Aligner) -> Iterator[list[list[str]]]:
    """Some texts at a time as lists of pieces, empty ones for those without tokens."""
    held, size = [], 0
    for i, text in enumerate(texts):
        text = text.as_py()
        held.append(aligner.pieces(text) if text else [])
        size += len(held[-1])
        if size > TURN or i + 1 == len(texts):
            yield held
            held, size = [], 0


def _tools(spark, byte_json: str, piece_model: bytes, pattern: str):
    """A function that gives a worker its Aligner; the files are as large as the vocabularies."""
    files, name = spark.sparkContext.broadcast((byte_json, piece_model, pattern)), hashlib.md5(byte_json.encode() + piece_model + pattern.encode()).hexdigest()
    return lambda: kept(("aligner", name), lambda: Aligner(*files.value))


def _counted(rows: DataFrame, aligner_of) -> DataFrame:
    """(code, n): how often each pair is linked, summed within tasks only."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, total = aligner_of(), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], names=["code", "n"])
            total.clear()
            return out

        for batch in batches:
            for turn in _in_turns(batch.column(1), aligner):
                times = Counter(chain.from_iterable(turn))
                found = aligner.of(times, texts=False)
                if odd := {p for p, ok in zip(found.pieces, found.ok.tolist()) if not ok}:
                    times = Counter(chain.from_iterable(own for own in turn if odd.isdisjoint(own)))
                each, at = np.unique(found.codes, return_inverse=True)
                sums = np.zeros(len(each), np.int64)
                np.add.at(sums, at, np.repeat(np.fromiter((times[p] for p in found.pieces), np.int64, len(found.pieces)), found.n))
                for code, n in zip(each[sums > 0].tolist(), sums[sums > 0].tolist()):
                    total[code] += n
                if len(total) > COUNTED:
                    yield flush()
        yield flush()

    return rows.mapInArrow(counted, "code long, n long")


def _parted(rows: DataFrame, parts: int) -> DataFrame:
    """rows (code, ...) with part, the part of the hash that the pair belongs to."""

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("part", pa.array(part_of(batch.column("code").to_numpy(), parts)))

    return rows.mapInArrow(parted, T.StructType([*rows.schema.fields, T.StructField("part", T.LongType())]))


def _hashed(key, rows: pd.DataFrame) -> pd.DataFrame:
    found = PerfectHash.of(np.sort(rows["code"].to_numpy()))
    return pd.DataFrame({"part": [key[0]], "seeds": [found.seeds.tobytes()], "keys": [found.keys.tobytes()]})


def _vector(key, counts: pd.DataFrame, hashes: pd.DataFrame) -> pd.DataFrame:
    """The counts of some tasks as one vector in the order of the hash."""
    found = PerfectHash(*(np.frombuffer(hashes[c].iloc[0], np.int64) for c in ("seeds", "keys")))
    at, dense = found.places(counts["code"].to_numpy()), np.zeros(len(found.keys), np.int64)
    if (at < 0).any():
        raise KeyError("a pair is not in the hash")
    np.add.at(dense, at, counts["n"].to_numpy())
    return pd.DataFrame({"part": [key[0]], "branch": [key[1]], "vector": [dense.tobytes()]})


def _added(key, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"part": [key[0]], "branch": [key[1]], "vector": [np.sum([np.frombuffer(v, np.int64) for v in rows["vector"]], axis=0).tobytes()]})


def pair_counts(partial: DataFrame) -> DataFrame:
    """(part, parts, seeds, keys, vector): a minimal perfect hash of the distinct codes, and their summed counts in its order.

    partial: (code, n, branch), branch the number of the task that has summed n. The
    hash is made of parts of some PART codes, each by a task. The counts of FAN
    tasks at a time become a dense vector of a part; vectors are added up as a tree,
    FAN to one, so that no task gets more however many have counted.
    """
    distinct = cut(partial.select("code").distinct())
    parts = max(1, -(-distinct.count() // PART))
    hashes = cut(_parted(distinct, parts).groupBy("part").applyInPandas(_hashed, "part long, seeds binary, keys binary"))
    discard(distinct)
    branch = (F.col("branch") / FAN).cast("long")
    counts = _parted(partial, parts).withColumn("branch", branch)
    branches = (partial.agg(F.max("branch")).first()[0] or 0) // FAN + 1
    each = hashes.withColumn("branch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(branches - 1).cast("long"))))
    needed = each.join(counts.select("part", "branch").distinct(), ["part", "branch"], "left_semi") if branches > 1 else each
    vectors = counts.groupBy("part", "branch").cogroup(needed.groupBy("part", "branch")).applyInPandas(_vector, "part long, branch long, vector binary")
    while branches > 1:
        branches = -(-branches // FAN)
        vectors = vectors.withColumn("branch", branch).groupBy("part", "branch").applyInPandas(_added, "part long, branch long, vector binary")
    return hashes.join(vectors.drop("branch"), "part").withColumn("parts", F.lit(parts))


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[c], np.int64) for c in ("seeds", "keys", "vector"))


_SUMS = "n_a long, n_b long, n_groups long, n_links long"


def _summed(rows: DataFrame, aligner_of, counts_of=None) -> DataFrame:
    """The columns of aligned(); without counts_of the links of each text and their number in place of n_best and count_sum."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counts = aligner_of(), counts_of and counts_of()
        for batch in batches:
            out = []
            for turn in _in_turns(batch.column(1), aligner):
                found = aligner.of(set(chain.from_iterable(turn)))
                place = {p: i for i, p in enumerate(found.pieces)}
                places = [np.fromiter(map(place.__getitem__, own), np.int64, len(own)) for own in turn]
                places = [at if found.ok[at].all() else at[:0] for at in places]
                if counts:
                    # Pieces that stand only in texts without tokens were not counted.
                    used, upto = np.zeros(len(found.n), bool), np.cumsum(found.n)
                    for at in places:
                        used[at] = True
                    used = np.repeat(used, found.n)
                    sums = []
                    for x in counts.of(found.codes[used])[::-1]:
                        whole = np.zeros(len(used) + 1, np.int64)
                        whole[1:][used] = x
                        whole = np.cumsum(whole)
                        sums.append(whole[upto] - whole[upto - found.n])
                for at in places:
                    if not len(at):
                        out.append((0, 0, 0, 0, "", *((0, 0) if counts else ([],))))
                        continue
                    text, n = "".join([found.texts[i] for i in at.tolist()])[:-1], int(found.n[at].sum())
                    if counts:
                        more = [int(x[at].sum()) for x in sums]
                    else:
                        more = [[{"code": c, "times": k} for c, k in zip(*(x.tolist() for x in np.unique(found.codes_of(at), return_counts=True)))]]
                    out.append((int(found.n_a[at].sum()), int(found.n_b[at].sum()), n, n, hashlib.sha256(text.encode()).hexdigest(), *more))
            columns = [pa.array(c, t.type) for c, t in zip(zip(*out), schema)] if out else [pa.array([], t.type) for t in schema]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *schema.names])

    more = [("n_best", pa.int64()), ("count_sum", pa.int64())] if counts_of else [("links", pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64())])))]
    schema = pa.schema([*((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), *more])
    kind = rows.schema["doc_id"].dataType.simpleString()
    rest = "n_best long, count_sum long" if counts_of else "links array<struct<code: long, times: long>>"
    return rows.mapInArrow(summed, f"doc_id {kind}, {_SUMS}, groups_sha256 string, {rest}")


def _joined_counts(rows: DataFrame, aligner_of, counted: DataFrame) -> DataFrame:
    """aligned() where the counts are too many to be broadcast: each text's different links are joined to them."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, keys, vector = _unpacked(row)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(vector)], names=["code", "count"])

    pairs = counted.mapInArrow(unpacked, "code long, count long")
    most = pairs.groupBy((F.col("code") % (1 << _SHIFT)).alias("b")).agg(F.max("count").alias("most"))
    pairs = pairs.withColumn("b", F.col("code") % (1 << _SHIFT)).join(F.broadcast(most), "b")  # a row for each piece of the vocabulary
    texts = cut(_summed(rows, aligner_of).withColumn("row", F.monotonically_increasing_id()))
    links = texts.select("row", F.explode("links").alias("l")).select("row", "l.code", "l.times")
    known = pairs.select("code", "count", (F.col("count") == F.col("most")).alias("best"), F.col("count").alias("n"))
    sums = joined(links, cut(known), ["code"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    return texts.drop("links").join(sums, "row", "left").na.fill(0, ["n_best", "count_sum"]).drop("row")


def aligned(docs: DataFrame, byte_json: str, piece_model: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A is the byte-level vocabulary, B the piece model. The first pass aligns all
    texts and counts how often each pair of ids is linked; the counts become dense
    vectors in the order of a minimal perfect hash of the pairs. The second pass
    aligns all texts again and looks their links up, with the key at each place
    verified. Up to BROADCAST_PAIRS pairs hash and counts are broadcast, beyond
    they are joined; the rows are the same.

    Null and empty texts, and texts whose bytes either vocabulary does not give back,
    have no tokens: zeros and ''. Rows with one id, or a null id, stay separate rows
    and each counts; other columns are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    aligner_of = _tools(spark, byte_json, piece_model, pattern)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    partial = cut(_counted(rows, aligner_of).withColumn("branch", F.spark_partition_id().cast("long")))
    counted = cut(pair_counts(partial))
    discard(partial)
    pairs = counted.agg(F.sum(F.length("keys") / 8)).first()[0] or 0
    if pairs > BROADCAST_PAIRS:
        return _joined_counts(rows, aligner_of, counted)
    found, parts = {}, 1
    for row in counted.toLocalIterator():
        found[row["part"]], parts = _unpacked(row), row["parts"]
    counts = spark.sparkContext.broadcast(PairCounts(found, parts))
    return _summed(rows, aligner_of, lambda: counts.value)

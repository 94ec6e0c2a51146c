"""Quality scores: random-indexing word vectors pooled by document, and a small calibrated network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, partitions

#: Words share so many vectors by hash, so that their table has one size whatever the corpus.
VECTORS, SIZE, NONZERO, REACH, SEED = 1 << 15, 32, 2, 2, 20240501
BLOCK = 256
#: Labelled rows at most that the network is fitted on, those whose ids hash lowest.
MAX_LABELLED = 20_000
THRESHOLD = 0.3
HIDDEN, EPOCHS, RATE, DECAY = 32, 60, 3e-3, 1e-4
WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Words that are counted at once.
AT_ONCE = 1 << 18


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each word vector, the few places that are not zero, and their signs."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, SIZE, (VECTORS, NONZERO)), rng.choice([-1, 1], (VECTORS, NONZERO))


class _Numbers(dict):
    """The vector of each word, by a hash; forgotten when many are held."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 150_000:
            self.clear()
        number = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % VECTORS
        return number


def word_numbers(texts: Iterator[str | None]) -> Iterator[tuple[list[int], np.ndarray]]:
    """(words of each text, their numbers one after another), for texts in groups of bounded size.

    A text of more words than a group holds is a group of its own.
    """
    numbers = kept("words", _Numbers)
    lengths: list[int] = []
    found: list[int] = []
    for text in texts:
        before = len(found)
        found.extend(map(numbers.__getitem__, WORDS.findall(text or "")))
        lengths.append(len(found) - before)
        if len(found) >= AT_ONCE:
            yield lengths, np.array(found, np.int64)
            lengths, found = [], []
    if lengths:
        yield lengths, np.array(found, np.int64)


def context_sums(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """The sum of the index vectors of all neighbours of each word, over every text: VECTORS x SIZE, whatever the corpus."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(VECTORS * SIZE, np.int64)
        texts = (t.as_py() for batch in batches for t in batch.column(0))
        for lengths, words in word_numbers(texts):
            text = np.repeat(np.arange(len(lengths)), lengths)
            for step in range(1, REACH + 1):
                same = text[step:] == text[:-step]
                ahead, behind = words[step:][same], words[:-step][same]
                for at, of in ((ahead, behind), (behind, ahead)):
                    for k in range(NONZERO):
                        total += np.bincount(at * SIZE + places[of, k], signs[of, k], VECTORS * SIZE).astype(np.int64)
        blocks = total.reshape(-1, BLOCK * SIZE)
        some = np.flatnonzero(blocks.any(axis=1))
        yield _blocks(some, blocks[some])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[block] = held.get(block, 0) + np.frombuffer(data, np.int64)
        if held:
            yield _blocks(np.array(list(held)), np.array(list(held.values())))

    parts = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(summed, "block int, sums binary")
    n = min(partitions(df.sparkSession), VECTORS // BLOCK)
    total = np.zeros((VECTORS // BLOCK, BLOCK * SIZE))
    for row in parts.repartition(n, "block").mapInArrow(merged, "block int, sums binary").collect():
        total[row.block] += np.frombuffer(row.sums, np.int64)
    return total.reshape(VECTORS, SIZE)


def _blocks(numbers: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array([b.astype(np.int64).tobytes() for b in blocks], pa.binary())], names=["block", "sums"]
    )


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Each word's own index vector beside its neighbours' sum at unit length."""
    places, signs = index_vectors()
    own = np.zeros((VECTORS, SIZE))
    np.add.at(own, (np.arange(VECTORS)[:, None], places), signs)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.concatenate([own, np.divide(sums, length, out=np.zeros_like(sums), where=length > 0)], axis=1).astype(np.float32)


def pooled(texts: Iterator[str | None], vectors: np.ndarray) -> Iterator[np.ndarray]:
    """Features of texts: mean word vector and its length, how often a word repeats the one before, and the number of words."""
    for lengths, words in word_numbers(texts):
        sizes = np.array(lengths)
        sums = np.zeros((len(sizes), vectors.shape[1]))
        ends = np.cumsum(sizes)
        again = np.zeros(len(words) + 1)
        again[1:-1] = words[1:] == words[:-1]
        again[ends - sizes] = 0
        repeats = np.add.reduceat(again, np.minimum(ends - sizes, len(again) - 1)) * (sizes > 0) if len(sizes) else again[:0]
        for i, (end, n) in enumerate(zip(ends.tolist(), lengths)):
            for at in range(end - n, end, 1 << 16):
                sums[i] += vectors[words[at : min(at + (1 << 16), end)]].sum(axis=0)
        mean = sums / np.maximum(sizes, 1)[:, None]
        own = np.linalg.norm(mean[:, :SIZE], axis=1)
        yield np.column_stack([mean, own, repeats / np.maximum(sizes, 1), np.log1p(sizes)])


@dataclass
class Network:
    """Two layers and the temperature of their output."""

    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the log loss; each fifth row is kept from it to set the temperature. No rows give 0.5 for all."""
    rng = np.random.default_rng(SEED)
    width = x.shape[1]
    net = Network(np.zeros(width), np.ones(width), rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    if not len(x):
        net.w2[:] = 0
        return net
    net.mean, net.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    order = rng.permutation(len(x))
    kept, held = (order[len(x) // 5 :], order[: len(x) // 5]) if len(x) >= 50 else (order, order)
    values = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    z = (x - net.mean) / net.spread
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(kept), max(1, len(kept) // 128)):
            hidden = np.tanh(z[rows] @ values[0] + values[1])
            off = (1 / (1 + np.exp(-np.clip(hidden @ values[2] + values[3], -60, 60))) - y[rows]) / len(rows)
            back = off[:, None] * values[2] * (1 - hidden**2)
            grads = [z[rows].T @ back + DECAY * values[0], back.sum(axis=0), hidden.T @ off + DECAY * values[2], np.array([off.sum()])]
            step += 1
            for v, g, m, s in zip(values, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(values[3][0])
    logits, truth = net.logits(x[held]), y[held]
    loss = lambda t: np.logaddexp(0, np.where(truth > 0, -logits, logits) / t).mean()
    net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def labelled(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", bound: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, label): of the labelled ids that are for learning, those whose hash is lowest, up to the bound.

    An id is for learning if crc32 of its text modulo 5 is not 0. An id with
    several labels has the smallest; null labels and ids do not count.
    """
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(F.crc32(F.col(id_col).cast("string")) % 5 != 0)
    one = rows.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def learned(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = MAX_LABELLED) -> tuple[np.ndarray, Network]:
    """Word vectors from all texts, and a network from at most so many labelled ones."""
    vectors = word_vectors(context_sums(df, text_col))
    held = df.sparkSession.sparkContext.broadcast(vectors)  # VECTORS x 2 SIZE

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pooled(batch.column(0).to_pylist(), held.value):
                flat = [row.astype(np.float32).tobytes() for row in part]
                yield pa.RecordBatch.from_arrays([pa.array(flat, pa.binary())], names=["x"])

    # The bound on labelled rows bounds both what is broadcast and what comes to the driver.
    chosen = F.broadcast(labelled(labels, bound=bound))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(chosen, "doc_id")
    # Of several texts with one id the smallest counts.
    one = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").cast("double").alias("label"))
    train = one.select("text", "label")
    both = train.mapInArrow(_labelled_features(features), "x binary, label double").collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in both], float).reshape(-1, 2 * SIZE + 3)
    y = np.array([r.label for r in both], float)
    order = np.lexsort((*x.T, y))  # the order in which tasks end does not matter
    return vectors, fit(x[order], y[order])


def _labelled_features(features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches(list(features(iter([batch.select([0])]))))
            yield pa.RecordBatch.from_arrays([rows.column(0).combine_chunks(), batch.column(1)], names=["x", "label"])

    return run


def scored(df: DataFrame, vectors: np.ndarray, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of df with score, the probability that the text is good, and predicted, 1 from a score of 0.3.

    Null and empty texts have the score of no words. Only the text counts. A
    column named score or predicted is replaced; no rows give no rows.
    """
    held = df.sparkSession.sparkContext.broadcast((vectors, network))

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors, network = held.value
        for batch in texts:
            parts = [network.probabilities(x) for x in pooled(batch.tolist(), vectors)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    score = F.pandas_udf(score, "double")
    return df.withColumn("score", score(F.col(text_col).cast("string"))).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

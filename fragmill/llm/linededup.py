"""Repeated runs of lines, found by winnowing over line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh, joined

WORDS = 50
#: Bytes of texts that are fingerprinted at once.
AT_ONCE = 1 << 22
#: Hashes of runs are polynomials of line hashes modulo a prime of 127 bits.
_PRIME, _BASE = (1 << 127) - 1, 0x5D1B9F3A7C26E84F0B63A1D5C9E7F241
_WINDOW = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("run", pa.binary())])
_CHOSEN = pa.schema([("doc_id", pa.int64()), ("body", pa.int64()), ("fp", pa.int64()), ("at", pa.int32()), ("windows", pa.list_(_WINDOW))])
_CHOSEN_DDL = "doc_id long, body long, fp long, at int, windows array<struct<first:int,last:int,run:binary>>"


def windows(counts: np.ndarray, least: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(first, last) of the shortest runs with so many words that begin at each line, and that end at each.

    counts are the words of each line; begins and ends bound each line's text.
    """
    upto = np.concatenate([[0], np.cumsum(counts)])
    line = np.arange(len(counts))
    last = np.searchsorted(upto, upto[:-1] + least) - 1
    ahead = np.stack([line, last], axis=1)[last < ends]
    first = np.searchsorted(upto, upto[1:] - least, side="right") - 1
    behind = np.stack([first, line], axis=1)[first >= begins]
    return np.unique(np.concatenate([ahead, behind]), axis=0)


def minima(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The place of the least value of each window (first, last), the rightmost of equals.

    Minima over spans that double in length; two of them make up a window.
    """
    order = np.lexsort((-np.arange(len(values)), values))
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    size = found[:, 1] - found[:, 0] + 1
    level = np.frexp(size)[1] - 1
    best = np.empty(len(found), np.int64)
    for k in range(int(level.max(initial=0)) + 1):
        at = level == k
        best[at] = np.minimum(rank[found[at, 0]], rank[found[at, 1] + 1 - (1 << k)])
        rank = np.minimum(rank[: -(1 << k) or None], rank[1 << k :]) if len(rank) > 1 << k else rank[:0]
    return order[best]


def run_hashes(digests: list[int], found: np.ndarray) -> bytes:
    """16 bytes for each window: equal for windows of equal lines, whatever stands around them."""
    upto, powers, value = [0], [1], 0
    for digest in digests:
        value = (value * _BASE + digest) % _PRIME
        upto.append(value)
    for _ in range(int((found[:, 1] - found[:, 0]).max(initial=0)) + 1):
        powers.append(powers[-1] * _BASE % _PRIME)
    return b"".join(((upto[last + 1] - upto[first] * powers[last + 1 - first]) % _PRIME).to_bytes(16, "little") for first, last in found.tolist())


def chosen(ids: list, bodies: list, texts: list[str], least: int) -> pa.RecordBatch:
    """(doc_id, body, fp, at, windows): the lines that winnowing chooses, each with the windows whose least line hash it has."""
    split = [text.encode("utf-8", "surrogatepass").split(b"\n") for text in texts]
    sizes = np.array([len(lines) for lines in split], np.int64)
    counts = np.fromiter((len(line.split()) for lines in split for line in lines), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(split)), sizes)
    end = np.cumsum(sizes)
    begin = end - sizes
    found = windows(counts, least, begin[text], end[text])
    digests = [xxhash.xxh3_128_intdigest(line) for lines in split for line in lines]
    short = np.fromiter((d & 0x7FFFFFFFFFFFFFFF for d in digests), np.int64, len(digests))
    at = minima(short, found)
    order = np.argsort(at, kind="stable")
    found, at = found[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.empty(0, np.int64)
    places = at[first]
    of = text[places]
    shift = begin[text[at]] if len(at) else at
    runs = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(found), [None, pa.py_buffer(run_hashes(digests, found))]).cast(pa.binary())
    each = [pa.array((found[:, 0] - shift).astype(np.int32)), pa.array((found[:, 1] - shift).astype(np.int32)), runs]
    listed = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.StructArray.from_arrays(each, fields=list(_WINDOW)))
    own = [pa.array([values[i] for i in of], pa.int64()) for values in (ids, bodies)]
    return pa.RecordBatch.from_arrays([*own, pa.array(short[places]), pa.array((places - begin[of]).astype(np.int32)), listed], schema=_CHOSEN)


def fingerprints(df: DataFrame, least: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, fp, at, windows) of every line that winnowing chooses; body is a hash of the text.

    A window is a shortest run of lines with so many words that begins, or that
    ends, at a line; it chooses its line of the least hash, the rightmost of
    equals. A line that several windows choose stands once, with all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                rows.append(row)
                size += len(row[2])
                if size >= AT_ONCE:
                    yield chosen(*zip(*rows), least)
                    rows, size = [], 0
            if rows:
                yield chosen(*zip(*rows), least)

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("body"), F.col(text_col).cast("string").alias("text"))
    return docs.where("text <> ''").mapInArrow(run, _CHOSEN_DDL)


def repeated_runs(df: DataFrame, least: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, first, last): windows of lines that stand earlier too, in the order (id, text hash, line).

    Equal windows choose equal lines, so only lines whose hash is chosen in two
    places are looked at further. Their places are joined, and each match of a
    line is extended both ways by the windows around it: a window goes as far as
    the earliest place with all of its lines agrees, by a hash of them. The
    windows that begin and that end at each line of a repeated run together cover
    it, so their union is the whole match. No fingerprint makes pairs: each window
    is compared with the first of its kind, an aggregate, and a line or passage
    that a third of all rows holds is dealt to all tasks.
    """
    found = cut(fingerprints(df, least, id_col, text_col))
    again = found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1")
    met = joined(found, cut(again), ["fp"])
    seen = cut(met.select("doc_id", "body", F.col("fp"), F.inline("windows")))
    place = F.struct("doc_id", "body", "first")
    kinds = seen.groupBy("run").agg(F.min(place).alias("origin"), F.count("*").alias("n")).where("n > 1")
    return joined(seen, cut(kinds), ["run"]).where(place > F.col("origin")).select("doc_id", "body", "first", "last")


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.ArrayType(T.IntegerType()))]))
def _without(text, spans):
    texts, gone = [], []
    for body, found in zip(text, spans):
        lines = body.split("\n")
        drop = np.zeros(len(lines) + 1, np.int64)
        for span in found:
            drop[span["first"]] += 1
            drop[span["last"] + 1] -= 1
        drop = np.cumsum(drop)[:-1] > 0
        texts.append("\n".join(line for line, out in zip(lines, drop) if not out))
        gone.append(np.flatnonzero(drop).astype(np.int32))
    return pd.DataFrame({"text": texts, "removed": gone})


def line_dedup(df: DataFrame, least: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of df, its text without the lines of later repeated runs, and removed: their numbers.

    A line goes if it lies in a run of lines with at least so many words that also
    begins at an earlier place: in a row with a smaller id, or further up. Lines
    end at newlines and are equal byte for byte; words are runs of anything but
    ASCII white space. Lines are counted from 0; removed is empty where all stay.

    A null or empty text stays as it is. Null ids come before others. Rows with
    one id are ordered by a hash of their texts, and rows that repeat both are
    one document and fare alike. A column named removed is replaced; no other
    column is touched, whatever its name. No rows give no rows.
    """
    key, body, spans, out = fresh(df.columns, "key", "body", "spans", "out")
    runs = repeated_runs(df, least, id_col, text_col)
    found = runs.groupBy("doc_id", "body").agg(F.collect_set(F.struct("first", "last")).alias(spans))
    found = found.select(F.col("doc_id").alias(key), F.col("body").alias(body), spans)
    rows = df.withColumn("removed", F.lit(None).cast("array<int>"))
    match = F.col(id_col).cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(body))
    both = rows.join(found, match, "left")
    changed = both.where(F.col(spans).isNotNull()).withColumn(out, _without(text_col, spans))
    kept = both.where(F.col(spans).isNull()).withColumn("removed", F.array().cast("array<int>"))
    return kept.select(rows.columns).unionByName(
        changed.withColumn(text_col, F.col(f"{out}.text")).withColumn("removed", F.col(f"{out}.removed")).select(rows.columns)
    )

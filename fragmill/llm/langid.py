"""Language identification by a string kernel, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

#: Lengths of n-grams that the spectrum blends, and the hash classes they share.
LENGTHS, CLASSES = (1, 2, 3), 1 << 13
#: Texts of a language that are learned from, about, and those of them that are landmarks, at most.
PER_LANGUAGE, LANDMARKS = 800, 192
#: Languages that are learned at most.
LANGUAGES = 256
RIDGE, SHARPNESS = 1e-3, 6.0
ROWS = 256
UNKNOWN = "und"
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _alphabet() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


_LETTERS: list[np.ndarray] = []


def presence(text: str | None) -> np.ndarray | None:
    """The classes of the n-grams that a text has, in lower case and with blanks for all but letters; None if it has no letter."""
    if not text:
        return None
    if not _LETTERS:
        _LETTERS.append(_alphabet())
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTERS[0][codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32).astype(np.uint32)
    blank = codes == 32
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
    seen = np.zeros(CLASSES, bool)
    rolled = np.zeros(len(codes), np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        rolled = (rolled[: len(codes) - n + 1] * np.uint32(_MIX[0]) + codes[n - 1 :]) if n > 1 else codes * np.uint32(_MIX[1])
        if n in LENGTHS:
            mixed = (rolled ^ np.uint32(n * _MIX[2] & 0xFFFFFFFF)) * np.uint32(_MIX[1])
            seen[(mixed ^ mixed >> np.uint32(15)) * np.uint32(_MIX[2]) >> np.uint32(32 - 13)] = True
    return seen


def unit(rows: np.ndarray) -> np.ndarray:
    """Presence rows at length one: their products are the normalised kernel."""
    return (rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))).astype(np.float32)


@dataclass
class Model:
    """Landmarks, and what turns kernels with them into a value for each language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def values(self, rows: np.ndarray) -> np.ndarray:
        return unit(rows) @ self.landmarks.T @ self.weights


def fit(rows: np.ndarray, langs: list[str]) -> Model:
    """One-versus-rest kernel ridge regression in the space of the landmarks, drawn from each language alike."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((0, CLASSES), np.float32), np.zeros((0, 0), np.float32))
    truth = np.array([languages.index(x) for x in langs])
    share = max(1, LANDMARKS // len(languages))
    marks = np.concatenate([np.flatnonzero(truth == i)[:share] for i in range(len(languages))])
    x = unit(rows)
    landmarks = x[marks]
    size, turn = np.linalg.eigh((landmarks @ landmarks.T).astype(float))
    keep = size > 1e-6
    root = turn[:, keep] / np.sqrt(size[keep])
    features = x @ landmarks.T @ root
    # Each language weighs alike, however many texts it has.
    weight = 1 / np.bincount(truth)[truth]
    goal = np.where(truth[:, None] == np.arange(len(languages)), 1.0, -1.0)
    left = features.T @ (features * weight[:, None]) + RIDGE * np.eye(features.shape[1])
    solved = np.linalg.solve(left, features.T @ (goal * weight[:, None]))
    return Model(languages, landmarks, (root @ solved).astype(np.float32))


def learning_sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, text, lang) of about so many texts of each language, by a hash of their ids.

    At most LANGUAGES languages are learned, those with the most texts: this bounds
    the sample, whatever a dirty column holds. Only rows whose crc32 of the id as text is not 1 modulo 3, with a language and
    a text, count. Null ids do not.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null").where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    # Languages join their rates; those beyond the most frequent are too rare to be told apart, and no driver holds them.
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    rates = F.broadcast(counts.select("lang", F.least(F.lit(1.0), per_language / F.col("n")).alias("rate")))
    draw = F.xxhash64(F.lit(11), "doc_id").bitwiseAND((1 << 53) - 1) / float(1 << 53)
    return rows.join(rates, "lang").where(draw < F.col("rate")).drop("rate")


def learned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model of the languages that the rows for learning have."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i.as_py(), s, x.as_py()) for i, t, x in zip(*batch.columns) if (s := presence(t.as_py())) is not None]
            bits = [np.packbits(s).tobytes() for _, s, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array(bits, pa.binary()), pa.array([r[2] for r in rows], pa.string())],
                names=["doc_id", "bits", "lang"],
            )

    sample = learning_sample(df, id_col, text_col, lang_col, per_language)
    found = sample.select(F.col("doc_id").cast("long"), "text", "lang").mapInArrow(packed, "doc_id long, bits binary, lang string").collect()
    found.sort(key=lambda r: (r.doc_id, r.lang, r.bits))
    rows = np.array([np.unpackbits(np.frombuffer(r.bits, np.uint8)) for r in found], np.float32).reshape(-1, CLASSES)
    return fit(rows, [r.lang for r in found])


_OUT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def identified(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows and columns of df with lang_pred, a language the model has learned, and score, its share from 0 to 1.

    A null text, one without a letter, and any text where nothing was learned are
    "und" with score 0. Columns named lang_pred or score are replaced; texts are
    read whole, and no rows give no rows.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = held.value
        for batch in batches:
            parts = [_predicted(batch.iloc[i : i + ROWS], model) for i in range(0, len(batch), ROWS)]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang": [], "score": []})

    udf = F.pandas_udf(predicted, _OUT)
    (both,) = fresh(df.columns, "both")
    rows = df.withColumn(both, udf(F.col(text_col).cast("string")))
    return rows.withColumn("lang_pred", F.col(f"{both}.lang")).withColumn("score", F.col(f"{both}.score")).drop(both)


def _predicted(texts: pd.Series, model: Model) -> pd.DataFrame:
    found = [presence(t) for t in texts]
    some = [i for i, s in enumerate(found) if s is not None and model.languages]
    langs, scores = [UNKNOWN] * len(found), [0.0] * len(found)
    if some:
        values = model.values(np.array([found[i] for i in some], np.float32)).astype(float)
        share = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        for i, best, row in zip(some, share.argmax(axis=1), share):
            langs[i], scores[i] = model.languages[best], float(row[best])
    return pd.DataFrame({"lang": langs, "score": scores})

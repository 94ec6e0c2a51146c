import zlib

import numpy as np

from fragmill.llm import langid as L

SCHEMA = "text string, lang string, doc_id long, score string, lang_pred string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.identified(docs, L.learned(docs)).toPandas()
    held = got[[zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98 and got["score"].between(0, 1).all()


def test_sample_keeps_to_its_folds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ids = [r.doc_id for r in L.learning_sample(docs, per_language=50).select("doc_id").collect()]
    assert 100 < len(ids) < 300 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)


def test_kernel_is_shared_grams_over_lengths():
    a, b = (L.presence(t) for t in ("Ab, c!", "abc  d"))
    k = float((L.unit(a[None].astype(float)) @ L.unit(b[None].astype(float)).T)[0, 0])
    assert abs(k - (a & b).sum() / np.sqrt(a.sum() * b.sum())) < 1e-6
    assert (L.presence("AB  c") == L.presence("ab 7 c")).all()
    grams = {t[i : i + n] for t in ["ab c "] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    assert L.presence("ab c ").sum() == len(grams)


def test_odd_rows(spark):
    rows = [(None, "en", 1, "s", "l"), ("", "en", 2, "s", "l"), ("12 34 !", "fr", 3, "s", "l"), ("the word " * 50_000, None, 4, None, None), ("été", "fr", None, "s", "l")]
    rows += [(f"the word and other {i}", "en", 10 + i, "s", "l") for i in range(20)] + [(f"le mot été où {i}", "fr", 40 + i, "s", "l") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = L.identified(df, L.learned(df))
    assert sorted(got.columns) == sorted(df.columns)
    found = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[4][0] == "en" and found[None][0] == "fr"
    nothing = L.learned(df.limit(0))
    assert {r.lang_pred for r in L.identified(df, nothing).collect()} == {"und"}
    assert L.identified(df.limit(0), nothing).count() == 0

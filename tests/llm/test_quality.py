import zlib

import numpy as np

from fragmill.llm import quality as Q

SCHEMA = "text string, doc_id long, score string, predicted string, label int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.scored(docs, *Q.learned(docs, labels)).select("doc_id", "score", "predicted").toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    held = got.merge(labels.toPandas(), on="doc_id")
    held = held[[zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id]]
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = [(i, i % 2) for i in range(200)] + [(3, 1), (None, 1), (4, None)]
    got = Q.labelled(spark.createDataFrame(rows, "doc_id long, quality int")).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in got) and len({r.doc_id for r in got}) == len(got)
    assert Q.labelled(spark.createDataFrame(rows, "doc_id long, quality int"), bound=9).count() == 9


def test_context_sums_against_plain_loops(spark):
    texts = ["a b c a", "b", "", None, "a a a", "x, y! z " * 30]
    places, signs = Q.index_vectors()
    want = np.zeros((Q.VECTORS, Q.SIZE))
    for t in texts:
        words = [zlib.crc32(w.encode()) % Q.VECTORS for w in Q.WORDS.findall(t or "")]
        for i, w in enumerate(words):
            for j in range(max(0, i - Q.REACH), min(len(words), i + Q.REACH + 1)):
                if i != j:
                    np.add.at(want[w], places[words[j]], signs[words[j]])
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert (Q.context_sums(df) == want).all()


def test_pooling_is_the_same_however_texts_are_grouped(monkeypatch):
    texts = ["a b c", "", None, "one one one two", "z", "q " * 500]
    vectors = Q.word_vectors(np.zeros((Q.VECTORS, Q.SIZE)))
    whole = np.concatenate(list(Q.pooled(iter(texts), vectors)))
    monkeypatch.setattr(Q, "AT_ONCE", 2)
    parts = np.concatenate(list(Q.pooled(iter(texts), vectors)))
    assert np.allclose(whole, parts) and len(whole) == 6 and abs(whole[3][-2] - 0.5) < 1e-9 and not whole[1].any()


def test_odd_rows(spark):
    rows = [(None, 1, "s", "p", 1), ("", 2, "s", "p", 0), ("word " * 100_000, 3, None, None, None), ("dup", 4, "s", "p", 1), ("dup", 4, "s", "p", 1), ("none", None, "s", "p", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 1)], "doc_id long, quality int")
    got = Q.scored(df, *Q.learned(df, labels))
    assert got.columns == ["text", "doc_id", "score", "predicted", "label"]
    assert got.where("score between 0 and 1 and predicted in (0, 1)").count() == 6
    empty = df.limit(0)
    assert Q.scored(empty, *Q.learned(empty, labels.limit(0))).count() == 0

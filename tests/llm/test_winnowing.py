import hashlib
import random

from fragmill.llm import winnowing as W


def kept(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return {r.i: [(g["hash"], g["at"]) for g in r.k] for r in W.with_winnowed(df, "text", "k").collect()}


def test_against_windows(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab é🙂") for _ in range(n)) for n in (8, 9, 20, 39, 40, 41, 90, 300)] + ["a" * 200]
    grams = sorted({t[i : i + 8] for t in texts for i in range(len(t) - 7)})
    known = {grams[i]: v[0][0] for i, v in kept(spark, grams).items()}
    got = kept(spark, texts)
    for n, t in enumerate(texts):
        h = [known[t[i : i + 8]] for i in range(len(t) - 7)]
        want = []
        for i in range(max(1, len(h) - 31)):
            at = min(range(i, min(i + 32, len(h))), key=lambda j: (h[j], -j))
            if (h[at], at) not in want:
                want.append((h[at], at))
        assert got[n] == want


def test_shared_passage_is_found(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(39))
    texts = ["".join(rng.choice("ijklmnop ") for _ in range(200)) + passage + "q" * n for n in (5, 80)]
    a, b = ({h for h, _ in v} for v in kept(spark, texts).values())
    assert a & b


def test_edited_and_next(spark):
    rng = random.Random(6)
    docs = [(i * 3 - 20, "".join(rng.choice("abc é") for _ in range(rng.choice([0, 1, 3, 7, 40, 50, 56, 200])))) for i in range(40)]
    docs[7] = (docs[7][0], None)
    got = {r.doc_id: r for r in W.edited_fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    docs = sorted((d, t or "") for d, t in docs)
    whole = kept(spark, [got[d].edited for d, _ in docs])
    assert all([(g["hash"], g["at"]) for g in got[d].edited_kept] == whole[i] for i, (d, _) in enumerate(docs))
    for i, (d, t) in enumerate(docs):
        after = docs[(i + 1) % len(docs)]
        edited = t[: len(t) - len(t) // 4] + after[1][: len(t) // 4]
        assert got[d].edited == edited and got[d].n_chars == len(t)
        sets = [{g["hash"] for g in x} for x in (got[d].kept, got[d].edited_kept, got[after[0]].kept)]
        for near, other in ((got[d].near_edited, sets[1]), (got[d].near_next, sets[2])):
            assert abs(near - (len(sets[0] & other) / len(sets[0] | other) if sets[0] | other else 1.0)) < 1e-12


def test_only_the_seam_is_winnowed_again(spark, monkeypatch):
    rng = random.Random(8)
    docs = [(i, "".join(rng.choice("abc é🙂") for _ in range(4000))) for i in range(3)]
    longest, plain = [], W.with_minima

    def noted(df, text_col, out):
        longest.append(df.agg(W.F.max(W.F.char_length(text_col))).first()[0])
        return plain(df, text_col, out)

    monkeypatch.setattr(W, "with_minima", noted)
    assert W.edited_fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).count() == 3
    assert longest == [4000, 76]


def test_edited_text_around_the_seam(spark):
    rng = random.Random(9)
    sizes = [0, 1, 3, 4, 37, 38, 39, 40, 49, 50, 51, 52, 53, 76, 77, 148, 151, 152, 153, 156, 157, 160, 300, 900]
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("a", "ab", "abc é🙂") for n in sizes]
    rng.shuffle(texts)
    rows = W.edited_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    whole = kept(spark, [r.edited for r in rows])
    for i, r in enumerate(rows):
        assert [(g["hash"], g["at"]) for g in r.edited_kept] == whole[i]


def test_odd_rows(spark):
    schema = "text string, doc_id long, next string, kept int, _v_kept int"
    rows = [("x" * 90_000, None, "a", 1, 1), ("same text", 4, "b", 2, 2), ("same text", 4, "c", 3, 3), (None, 9, None, None, None)]
    got = W.edited_fingerprints(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == [(-1, 90_000), (4, 9), (4, 9), (9, 0)]
    lone = W.edited_fingerprints(spark.createDataFrame([("abcdefgh", 1)], "text string, doc_id long")).collect()
    assert [r.edited for r in lone] == ["abcdefab"]
    assert W.edited_fingerprints(spark.createDataFrame([], "text string, doc_id long")).count() == 0


def test_equal_texts_have_equal_digests(spark):
    df = spark.createDataFrame([("some longer text " * 9,), ("some longer text " * 9,), ("other",)], "text string")
    a, b, c = (r.d for r in W.with_winnowed(df, "text", "k").select(W.digest(W.F.col("k")).alias("d")).collect())
    assert a == b != c and len(a) == len(hashlib.md5().hexdigest())

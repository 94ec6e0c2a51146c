import random

import numpy as np
import pytest

from fragmill.llm import neardup
from fragmill.llm.neardup import _sides, near_duplicates, one_of_each, rare_pairs, rarest, sampled
from fragmill.llm.simhash import shingle_hashes, simhash

SCHEMA = "node string, text string, doc_id long, fps int, same string"


def shingles(text, k):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k=5, least=0.8):
    sets = [(d, shingles(t, k)) for t, d in rows]
    root = {i: i for i in range(len(sets))}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if len(a & b) >= least * len(a | b):
                x, y = sorted((top(i), top(j)), key=lambda n: sets[n][0])
                root[y] = x
    return {d: sets[top(i)][0] for i, (d, _) in enumerate(sets)}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return words


def test_groups_match_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for g in range(25):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 8, 30, 120, 400]))]
        head = [f"shared{i}" for i in range(rng.choice([0, 12]))]
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((" ".join(head + edited(rng, base, rng.choice([0, 1, 2, 5]))), len(rows)))
    df = spark.createDataFrame([("n", t, d, 1, "s") for t, d in rows], SCHEMA)
    got = {r.doc_id: r.group_id for r in near_duplicates(df).collect()}
    want = brute(rows)
    wrong = [d for d in want if got[d] != want[d]]
    assert not wrong


def test_real_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.text, r.doc_id) for r in docs.collect()]
    assert {r.doc_id: r.group_id for r in near_duplicates(docs).collect()} == brute(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(brute(rows).values())


def test_odd_rows(spark):
    rows = [("n", None, 5, 1, "s"), ("n", "", 3, 1, "s"), (None, " \n", None, 1, "s"), ("n", "a b", 7, 1, "s"), ("n", "A  b", 6, 2, "t"), ("n", "a b", 7, 3, "u"), ("n", "z y x w v " * 20_000, 9, 1, "s")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 6, 9]
    assert one_of_each(df.limit(0)).count() == 0


def test_star_whose_middle_has_the_largest_id(spark):
    rng = random.Random(5)
    middle = [f"w{i}" for i in range(304)]
    texts = []
    for _ in range(1000):
        words = list(middle)
        for i in range(rng.randrange(30), 304, 51):
            words[i] = f"new{rng.random()}"
        texts.append(" ".join(words))
    texts.append(" ".join(middle))
    a, b, c = (shingles(texts[i], 5) for i in (0, 1, 1000))
    assert len(a & b) < 0.8 * len(a | b) and all(len(s & c) >= 0.8 * len(s | c) for s in (a, b))
    df = spark.createDataFrame([("n", t, d, 1, "s") for d, t in enumerate(texts)], SCHEMA)
    assert [r.doc_id for r in one_of_each(df).collect()] == [0]


def test_copies_that_share_boilerplate_with_others_are_linked(spark):
    rng = random.Random(7)
    frame = [f"frame{i}" for i in range(150)]
    texts = []
    for _ in range(150):
        texts.append(" ".join(frame + [f"w{rng.random()}" for _ in range(50)]))
    for _ in range(300):
        words = frame + [f"w{rng.random()}" for _ in range(58)]
        texts.append(" ".join(words))
        texts.append(" ".join(edited(rng, words[:150], 0) + edited(rng, words[150:], 3)))
    rng.shuffle(texts)
    rows = [(t, d) for d, t in enumerate(texts)]
    df = spark.createDataFrame([("n", t, d, 1, "s") for t, d in rows], SCHEMA)
    assert {r.doc_id: r.group_id for r in near_duplicates(df).collect()} == brute(rows)


def test_clashing_columns_stay(spark):
    names = ["_id", "_body", "_key", "number", "body", "key", "_salt"]
    df = spark.createDataFrame([(i, "a b", *names) for i in (2, 1)], f"doc_id long, text string, {' string, '.join(names)} string")
    (row,) = one_of_each(df).collect()
    assert row.doc_id == 1 and list(row)[2:] == names


def templates(rng, n, common=0.85, size=200):
    """Texts that have so much in common, and for each tenth a near copy."""
    frame = [f"frame{i}" for i in range(int(size * common))]
    texts = [frame + [f"w{rng.random()}" for _ in range(size - len(frame))] for _ in range(n)]
    return [" ".join(t) for t in texts] + [" ".join(t[:-1] + [f"w{rng.random()}"]) for t in texts[::10]]


def kinds_of(spark, texts):
    counts = {}
    for t in texts:
        for h in np.unique(shingle_hashes(t, 5)).tolist():
            counts[h] = counts.get(h, 0) + 1
    often = np.array(sorted(h for h, n in counts.items() if n > 1), np.uint64)
    ranks = np.array([counts[h] for h in often.tolist()])
    rows = [((d, d), d, len(np.unique(shingle_hashes(t, 5))), *rarest(shingle_hashes(t, 5), 0.8, often, ranks)) for d, t in enumerate(texts)]
    kinds = spark.createDataFrame(rows, "node struct<doc_id:long,body:long>, kind long, n int, rare array<long>, bits array<long>")
    return kinds, spark.createDataFrame([], "node struct<doc_id:long,body:long>, root struct<doc_id:long,body:long>")


def test_meetings_at_a_template_grow_in_proportion(spark):
    met = []
    for n in (100, 200, 400):
        x, y, _ = _sides(*kinds_of(spark, templates(random.Random(n), n)), 0.8)
        met.append(x.join(y, ["shingle", "part"]).count())
    assert met[0] > 0 and met[2] <= 4.4 * met[0]


@pytest.mark.parametrize("common", [0.7, 0.86, 0.9])
def test_rare_pairs_hold_every_similar_pair(spark, common):
    rng = random.Random(3)
    texts = templates(rng, 40, common) + templates(rng, 20, common, 230) + [" ".join(t.split()[:k]) for t in templates(rng, 6, common) for k in (165, 175, 185, 195)]
    found = {tuple(sorted((r.a.doc_id, r.b.doc_id))) for r in rare_pairs(*kinds_of(spark, texts), 0.8).collect()}
    sets = [shingles(t, 5) for t in texts]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert want <= found and want


def test_texts_within_three_bits_meet_by_the_ball(spark, monkeypatch):
    # What is repeated weighs in the SimHash, not in the samples of the set: the pair is near, yet no sample is alike.
    rng = random.Random(303)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)] * 12
    a, b = (base + [f"new{rng.randrange(10**6)}" for _ in range(48)] for _ in range(2))
    x, y = (shingle_hashes(" ".join(t), 5) for t in (a, b))
    assert not set(enumerate(sampled(x)[3])) & set(enumerate(sampled(y)[3])) and 0 < (simhash(x) ^ simhash(y)).bit_count() <= 3
    p, q = shingles(" ".join(a), 5), shingles(" ".join(b), 5)
    assert len(p & q) >= 0.8 * len(p | q)
    node = neardup.F.col("node")
    monkeypatch.setattr(neardup, "rare_pairs", lambda kinds, *_: kinds.select(node.alias("a"), node.alias("b")).limit(0))
    df = spark.createDataFrame([("n", " ".join(t), d, 1, "s") for d, t in ((4, b), (2, a), (9, ["other"] * 3))], SCHEMA)
    assert sorted((r.doc_id, r.group_id) for r in near_duplicates(df).collect()) == [(2, 2), (4, 2), (9, 9)]

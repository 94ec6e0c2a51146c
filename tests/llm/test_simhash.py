import random

import numpy as np
import pandas as pd
import xxhash

from fragmill.llm import simhash as S
from fragmill.llm.common import components

SCHEMA = "text string, doc_id long, lang string, fp long, h string"


def plain_fp(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    runs = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, near):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in near:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def brute(rows, words):
    fps = {}
    for text, doc_id in rows:
        fps.setdefault(plain_fp(text, words), []).append(doc_id)
    keys = list(fps)
    near = [(min(fps[a]), min(fps[b])) for i, a in enumerate(keys) for b in keys[:i] if (a ^ b).bit_count() <= 3]
    top = roots([min(v) for v in fps.values()], near)
    return sorted((d, f"{k:016x}", top[min(v)]) for k, v in fps.items() for d in v)


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.text, r.doc_id) for r in docs.collect()]
    got = S.simhash_groups(docs, words=3).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, 3)


def test_odd_rows(spark):
    rows = [(None, 5), ("", 3), (" \t\n", 4), ("one", 7), ("ONE", 6), ("a b", 8), ("A\x0bB", 9), ("a b", 8), ("é x " * 9000, 1)]
    df = spark.createDataFrame([(t, d, None, 1, "h") for t, d in rows], SCHEMA)
    got = S.simhash_groups(df, words=3).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, 3)
    assert S.simhash_groups(df.limit(0)).count() == 0


def test_links_connect_all_pairs_within_three_bits(spark):
    rng = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            f = base
            for _ in range(rng.randint(0, 5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
        for block in range(4):
            fps.add(base ^ (7 << (16 * block + 2)))
    lone = rng.getrandbits(64)
    fps |= {lone, lone ^ 7, lone ^ (1 << 63), lone ^ (1 << 63 | 1 << 40 | 1 << 3)}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    want = roots(signed, near)
    distinct = spark.createDataFrame(pd.DataFrame({"fp": signed}), "fp long")
    got = {r.node: r.root for r in components(S.near_links(distinct)).collect()}
    assert {n: got.get(n, n) for n in signed} == want


def test_group_split_by_batches(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 4)
    import pyarrow as pa

    keys = np.sort(np.repeat(np.arange(6), 5)).astype(np.int64)
    fps = np.arange(30, dtype=np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 3]), pa.array(fps[i : i + 3])], names=["key", "fp"]) for i in range(0, 30, 3)]
    pairs = [p for b in S.ball_links(iter(batches)) for p in zip(*(c.to_pylist() for c in b.columns))]
    assert pairs and all(a // 5 == b // 5 for a, b in pairs)

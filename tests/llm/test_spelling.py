import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fragmill.llm import queries
from fragmill.llm.spelling import Acceptor, OneEdit, counted_words, near_pairs, spelling_groups, spelling_variants


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words: dict[str, int], ratio: int = 10) -> dict[str, tuple]:
    """By trying every edit, and by comparing in code-point order."""
    neighbours: dict[str, set[str]] = {w: set() for w in words}
    holes: dict[tuple, list[str]] = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                neighbours[w].add(shorter)
                neighbours[shorter].add(w)
    for same in holes.values():
        for a in same:
            neighbours[a].update(b for b in same if b != a)
    form = {}
    for w, found in neighbours.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (words[w], form[w], words.get(form[w]), len(neighbours[w]), root)
    return out


def brute_words(docs: list[tuple], every: int = 31) -> dict[str, int]:
    total: Counter = Counter()
    for doc, text in docs:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{doc}:{run}".encode())
                if h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                total[run] += 1
                run = ""
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def rows_of(df) -> dict[str, tuple]:
    return {r["word"]: (r["n"], r["form"], r["form_n"], r["n_near"], r["root"]) for r in df.collect()}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=40))
def test_composition_accepts_each_near_pair_once(words):
    machine = Acceptor(sorted(words))
    found = [tuple(sorted(p)) for p in OneEdit(machine, True).pairs()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    machine = Acceptor(sorted(a + b + c for a in "abc" for b in "abc" for c in "abc"))
    reached, todo = set(), [0]
    while todo:
        q = todo.pop()
        if q not in reached:
            reached.add(q)
            todo += machine.arcs[q].values()
    assert len(reached) == 4


@pytest.mark.parametrize("group", [20_000, 3])
def test_near_pairs_equal_brute_force_with_and_without_split_partitions(spark, group):
    rng = random.Random(5)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 11))) for _ in range(300)} | {"a" * n for n in range(7, 14)}
    words |= {"prefixes" + x for x in ("", "a", "b", "ab", "ba")} | {x + "suffixes" for x in ("", "a", "b", "ab", "ba")}
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(sorted(words))], "word string, n long")
    found = [tuple(sorted((r["a"], r["b"]))) for r in near_pairs(df, group=group).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_forms_and_roots(spark):
    words = {"abcdefg": 1000, "abcdefgh": 90, "abcdefghi": 9, "abcdefgx": 9, "zzzzzzz": 5, "zzzzzzy": 50, "zzzzzzx": 50, "zzzzzza": 6}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = rows_of(spelling_groups(df))
    assert found == brute_groups(words)
    assert found["abcdefghi"] == (9, "abcdefgh", 90, 1, "abcdefg")
    assert found["zzzzzzz"][1] == "zzzzzzx"


def test_words_of_odd_texts(spark):
    docs = [(1, "Straße STRASSEN straßen Ébauche-ébauche ébauches 12abcdefgh34abcdefgh"), (2, None), (3, ""), (4, "x" * 3_000 + " " + "x" * 3_000), (5, "Straßen " * 40), (5, "Straßen " * 40), (None, "Nullnull Nullnull")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    found = rows_of(spelling_variants(df))
    assert found == brute_groups(brute_words([("null" if d is None else d, t) for d, t in docs]))
    assert spelling_variants(df.limit(0)).collect() == []


def test_counts_do_not_depend_on_flushes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"wordword{i % 7} other{i}") for i in range(200)], "doc_id long, text string").coalesce(1)
    before = {tuple(r) for r in counted_words(docs, every=31).collect()}
    monkeypatch.setattr("fragmill.llm.spelling.COUNTED", 3)
    assert {tuple(r) for r in counted_words(docs, every=31).collect()} == before


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows_of(queries.op13_spelling_variants(spark, folder)) == brute_groups(brute_words(docs))

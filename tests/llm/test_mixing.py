import warnings

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fragmill.llm import mixing as M
from fragmill.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, weight int, rate string"


def docs(spark, n=600):
    rows = [(i, " ".join(f"w{(i * 7 + j) % (5 + i % 11)}" for j in range(3 + i % 40)), "en" if i % 3 else "fr", "big" if i % 4 else f"s{i % 3}", 1, "r") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(cells, targets, dims):
    w = cells["tokens"].astype(float).copy()
    for _ in range(400):
        for d in dims:
            own = cells.groupby(d)["tokens"].sum()
            free = own[~own.index.isin(targets[d])]
            present = {k: v for k, v in targets[d].items() if k in own.index}
            unit = (own.sum() - free.sum()) / sum(present.values())
            goal = cells[d].map(lambda v: present[v] * unit if v in present else own[v])
            w = w * goal / w.groupby(cells[d]).transform("sum")
    return w


def coded(cells, targets):
    values = {d: sorted({*cells[d], *t}) for d, t in targets.items()}
    codes = {d: np.array([values[d].index(v) for v in cells[d]], int) for d in targets}
    return cells["tokens"].to_numpy(float), codes, {d: np.array([t.get(v, np.nan) for v in values[d]]) for d, t in targets.items()}


def test_raking_meets_all_marginals():
    cells = pd.DataFrame([(s, l, 10.0 + 7 * i * j + j) for i, s in enumerate("abc") for j, l in enumerate("xyz")], columns=["s", "l", "tokens"])
    targets = {"s": {"a": 3.0, "b": 1.0, "gone": 9.0}, "l": {"x": 1.0, "y": 1.0, "z": 2.0}}
    got, off = M.raked(*coded(cells, targets))
    assert off <= M.TOLERANCE and abs(got - brute(cells, targets, ["s", "l"]).to_numpy()).max() < 1e-3


def test_targets_in_conflict_say_how_far_they_are():
    # Only a has x, so half of x and a tenth of a cannot both be.
    cells = pd.DataFrame([("a", "x", 10.0), ("a", "y", 90.0), ("b", "y", 50.0)], columns=["s", "l", "tokens"])
    _, off = M.raked(*coded(cells, {"s": {"a": 1.0, "b": 9.0}, "l": {"x": 1.0, "y": 1.0}}))
    assert off > 0.1
    assert M.raked(*coded(cells.iloc[:0], {"s": {}, "l": {"x": 1.0}}))[1] == 0.0


def bounded(cells, goals, budget):
    """Projections in small steps: each class's factor by bisection, weights capped at the tokens."""
    u, cap = cells["tokens"].to_numpy(float).copy(), cells["tokens"].to_numpy(float)
    for _ in range(300):
        for d, goal in goals.items():
            for v, g in goal.items():
                own = (cells[d] == v).to_numpy()
                low, high = 0.0, 1e9
                for _ in range(200):
                    middle = (low + high) / 2
                    low, high = (middle, high) if np.minimum(u[own] * middle, cap[own]).sum() < g else (low, middle)
                u[own] *= high
    return np.minimum(u, cap)


def test_bounded_raking_meets_what_can_be_met():
    cells = pd.DataFrame([(s, l, 10.0 + 7 * i * j + 30 * j) for i, s in enumerate("abc") for j, l in enumerate("xyz")], columns=["s", "l", "tokens"])
    budget = 0.5 * cells["tokens"].sum()
    goals = {"s": {"a": 0.25 * budget, "b": 0.35 * budget, "c": 0.4 * budget}, "l": {"x": 0.08 * budget, "y": 0.42 * budget, "z": 0.5 * budget}}
    got, off = M.raked(*coded(cells, goals), budget)
    assert off <= M.TOLERANCE and (got <= cells["tokens"] + 1e-9).all() and abs(got.sum() - budget) < 1e-3
    assert abs(got - bounded(cells, goals, budget)).max() < 1e-2
    for d in goals:
        for v, g in goals[d].items():
            assert abs(got[(cells[d] == v).to_numpy()].sum() - g) < 1e-3


def test_a_target_above_the_tokens_takes_them_all_and_says_so():
    cells = pd.DataFrame([("a", 10.0), ("b", 60.0), ("c", 130.0)], columns=["s", "tokens"])
    got, off = M.raked(*coded(cells, {"s": {"a": 1.0, "b": 1.0, "c": 2.0}}), 100.0)
    assert got.tolist() == pytest.approx([10.0, 30.0, 60.0]) and off == pytest.approx(0.6)
    assert M.raked(*coded(cells, {"s": {"a": 1.0}}), 300.0)[0].tolist() == pytest.approx([10.0, 60.0, 130.0])
    # b and c have no targets and keep their shares of half of all; a has less than the rest.
    assert M.raked(*coded(cells, {"s": {"a": 1.0}}), 100.0)[0].tolist() == pytest.approx([5.0, 30.0, 65.0])
    assert M.raked(*coded(cells, {"s": {"a": 1.0}}), 0.0)[0].tolist() == [0.0, 0.0, 0.0]
    assert M.reachable(np.array([5.0, 0.0, 0.0]), np.array([1.0, 2.0, 6.0])).tolist() == [1.0, 1.0, 3.0]


def test_given_documents_meet_their_tempered_targets(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("about", F.lit("all"))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        rows = M.mixed(df, topic_col="about").select("_source", "_lang", "_tokens", "_probability").toPandas()
    budget, expected = 0.5 * rows["_tokens"].sum(), rows["_probability"] * rows["_tokens"]
    assert abs(expected.sum() / budget - 1) < 1e-4
    for dim in ("_source", "_lang"):
        own = rows.groupby(dim)["_tokens"].sum()
        off = expected.groupby(rows[dim]).sum() / (own**0.7 / (own**0.7).sum() * budget) - 1
        assert abs(off).max() < 0.01, (dim, off)


def test_registered_query_warns_where_topics_settle_languages(spark):
    with pytest.warns(UserWarning, match="worst marginal"):
        rows = queries.op9_mixing(spark, "/root/testdata/sf0.01").toPandas()
    assert rows["probability"].between(0, 1).all() and len(rows) == 1000
    expected = (rows["probability"] * rows["n_tokens"]).sum()
    assert abs(expected / rows["n_tokens"].sum() - 0.5) < 1e-3


def test_small_values_are_raked_together(spark):
    rows = [(i, "w " * 4, "en", "big" if i < 900 else f"tiny{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = M.mixed(df, 0.5, targets={"source": {"big": 1.0, "tiny950": 1.0}}).toPandas()
    by = got.groupby("_source")["_probability"].first()
    assert by["tiny950"] == pytest.approx(1) and by["tiny901"] == by["tiny999"] and set(got["_source"]) == set(got["source"])


def test_probabilities_give_the_budget_and_the_targets(spark):
    got = M.mixed(docs(spark), fraction=0.2, targets={"lang": {"en": 1.0, "fr": 1.0}}).toPandas()
    assert len(got) == 600 and got["_probability"].between(0, 1).all()
    expected = got["_probability"] * got["_tokens"]
    assert abs(expected.sum() / got["_tokens"].sum() - 0.2) < 0.002
    assert abs(expected.groupby(got["_lang"]).sum()["en"] / expected.sum() - 0.5) < 0.02
    again = M.mixed(docs(spark).orderBy("text"), fraction=0.2, targets={"lang": {"en": 1.0, "fr": 1.0}}).toPandas()
    assert set(again[again["_picked"]].doc_id) == set(got[got["_picked"]].doc_id)
    assert M.mixed(docs(spark), fraction=1.0, power=1.0).where("not _picked").count() == 0


def test_topics_can_be_given(spark):
    rows = docs(spark, 200).withColumn("about", F.when(F.col("doc_id") < 20, "rare").when(F.col("doc_id") < 190, "common"))
    got = M.mixed(rows, 0.3, targets={"topic": {"rare": 1.0, "common": 1.0}}, topic_col="about").toPandas()
    assert set(got["_topic"]) == {"rare", "common", "(none)"} and (got[got["_topic"] == "rare"]["_probability"] > 0.99).all()


def test_topics_and_tokens(spark):
    rows = M.with_tokens_and_topic(docs(spark, 80)).selectExpr("*", "transform(filter(split(text, ' '), w -> w <> ''), w -> pmod(hash(w), 8)) as c").toPandas()
    for r in rows.itertuples():
        counts = [list(r.c).count(t) for t in range(8)]
        assert r[7] == len(r.c) and r[8] == f"t{counts.index(max(counts))}"


def test_odd_rows(spark):
    rows = [(None, None, None, None, 1, "r"), (2, "", "en", None, 1, "r"), (2, "", "en", None, 2, "r"), (3, "word " * 60_000, None, "s", 1, "r")]
    got = M.mixed(spark.createDataFrame(rows, SCHEMA), fraction=1.0).toPandas()
    assert len(got) == 4 and list(got.columns[:6]) == ["doc_id", "text", "lang", "source", "weight", "rate"]
    assert set(got["_source"]) == {"(none)", "s"} and got["_tokens"].max() == 60_000
    assert M.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = docs(spark, 30).withColumn("_lang", F.lit("x")).withColumn("_salt", F.lit("y")).withColumn("tokens", F.lit(1))
    got = M.mixed(clash)
    assert len(set(got.columns)) == len(got.columns) == 14 - 0 and set(got.toPandas()["_lang"]) == {"en", "fr"}

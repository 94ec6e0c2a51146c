import threading

import pytest

from fragmill.llm import shards as S
from fragmill.llm.common import scratch_dir

SCHEMA = "doc_id long, text string, bytes int, tier string, arrival string, file int"


def rows(spark, n, start=0):
    return spark.createDataFrame([(i, f"text {i} " * 20, i, None, "a", i) for i in range(start, start + n)], SCHEMA)


def store(spark, **more):
    return S.ShardStore(spark, scratch_dir(spark), rows(spark, 0).schema, **more)


def test_every_row_once_in_few_shards(spark):
    s = store(spark, target_bytes=1 << 20)
    df = rows(spark, 500).repartition(8)
    got = S.sharded(df, s, arrivals=8)
    assert got.drop("_shard").exceptAll(df).count() == 0 and got.count() == 500
    tiers = {r.tier: r.n for r in s.manifest().groupBy("tier").count().withColumnRenamed("count", "n").collect()}
    assert all(n < s.fan_in for t, n in tiers.items() if t)
    assert {r[0] for r in got.select("_shard").distinct().collect()} == set(range(s.manifest().count()))


def test_shard_numbers_do_not_change(spark):
    df = rows(spark, 300).repartition(4, "doc_id")
    a, b = (S.sharded(df, store(spark, target_bytes=1 << 12), arrivals=6).select("doc_id", "_shard") for _ in range(2))
    assert a.exceptAll(b).count() == 0 and a.select("_shard").distinct().count() > 1


def test_versions_are_whole_and_kept(spark):
    s = store(spark, target_bytes=4000, fan_in=2)
    assert s.version() == 0 and s.manifest().count() == 0
    assert (s.append(rows(spark, 5)), s.append(rows(spark, 7))) == (1, 2)
    last = s.compact()
    assert s.read(1).count() == 5 and s.read(last).count() == 12
    s.vacuum(retain=2)
    assert s.read().count() == s.read(last - 1).count() == 12
    with pytest.raises(LookupError):
        s.read(1)


def test_of_two_writers_one_conflicts_and_append_tries_again(spark, monkeypatch):
    s = store(spark)
    s.append(rows(spark, 3))
    base = s.version()
    s._commit(s.manifest(base), base)
    with pytest.raises(S.Conflict):
        s._commit(s.manifest(base), base)
    other, commit, calls = S.ShardStore(spark, s.path, s.schema), S.ShardStore._commit, []

    def slow(self, manifest, base):
        calls.append(base)
        if len(calls) == 1:
            commit(other, other.manifest(base).unionByName(other._written(other.landed(rows(spark, 4, 10))[0])), base)
        return commit(self, manifest, base)

    monkeypatch.setattr(S.ShardStore, "_commit", slow)
    s.append(rows(spark, 2, 20))
    assert len(calls) == 2 and s.read().count() == 9


def test_many_writers_lose_nothing(spark):
    s = store(spark)
    writers = [threading.Thread(target=S.ShardStore(spark, s.path, s.schema).append, args=(rows(spark, 5, 5 * i),)) for i in range(5)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert s.version() == 5 and sorted(r.doc_id for r in s.read().collect()) == list(range(25))


@pytest.mark.parametrize("step", ["createLink", "parquet"])
def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, monkeypatch, step):
    s = store(spark)
    s.append(rows(spark, 3))
    with monkeypatch.context() as m:
        if step == "createLink":
            # The draft is written; the writer dies before it is put in place.
            m.setattr(S.ShardStore, "_publish", lambda self, path, content: (_ for _ in ()).throw(KeyboardInterrupt))
        else:
            m.setattr(S.ShardStore, "_commit", lambda self, manifest, base: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            s.append(rows(spark, 4, 10))
    assert s.version() == 1 and s.read().count() == 3
    assert s.append(rows(spark, 2, 20)) == 2 and s.read().count() == 5


def test_vacuum_spares_a_writer_in_flight(spark):
    s, other = store(spark), None
    other = S.ShardStore(spark, s.path, s.schema)
    s.append(rows(spark, 3))
    (folder,) = other.landed(rows(spark, 4, 10))
    s.append(rows(spark, 2, 20))
    s.vacuum(retain=1)
    other.admit(folder)
    assert s.read().count() == 9
    leftover = other.landed(rows(spark, 4, 30))[0]
    s.vacuum(leftover_age=-60)
    assert not s._list(leftover) and s.read().count() == 9


def test_a_merge_is_dropped_if_its_shards_are_gone(spark):
    s = store(spark, fan_in=2)
    s.append(rows(spark, 3))
    s.append(rows(spark, 3, 10))
    parts = [r.shard for r in s.manifest().collect()]
    s.compact()
    version = s.version()
    s._replace(parts, s._written(s.landed(rows(spark, 6))[0]))
    assert s.version() == version and s.read().count() == 6


def test_odd_rows(spark):
    odd = spark.createDataFrame(
        [(None, None, 1, "t", None, 1), (1, "", 2, "t", "b", 2), (1, "", 2, "t", "b", 2), (2, "x" * 300_000, 3, None, "c", None)], SCHEMA
    )
    got = S.sharded(odd, store(spark), arrivals=3)
    assert got.drop("_shard").exceptAll(odd).count() == 0 and got.count() == 4
    empty = S.sharded(odd.limit(0), store(spark), arrivals=2)
    assert empty.count() == 0 and empty.columns == [*odd.columns, "_shard"]
    assert store(spark).read().count() == 0
    own = odd.select("doc_id", "text").withColumn("_shard", odd["text"])
    again = S.sharded(own, S.ShardStore(spark, scratch_dir(spark), own.schema), arrivals=2)
    assert again.count() == 4 and dict(again.dtypes)["_shard"] == "int"


def test_many_shards_are_numbered_like_few(spark, monkeypatch):
    s = store(spark, target_bytes=1 << 12)
    S.sharded(rows(spark, 300).repartition(4, "doc_id"), s, arrivals=6)
    few = s.read().select("doc_id", "_shard")
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(S, "BROADCAST_SHARDS", 0)
    many = s.read().select("doc_id", "_shard")
    assert few.count() == many.count() == 300 and few.exceptAll(many).count() == 0

import json
import time

import pytest
from pyspark.sql import functions as F

from fragmill.sources import markers
from fragmill.sources.markers import MarkerSource


@pytest.fixture
def build(tmp_path):
    for i in range(4):
        folder = tmp_path / f"molecule_id={i}" / "deep"
        folder.mkdir(parents=True)
        (folder / "_SUCCESS").write_text(json.dumps({"status": "success", "molecule_id": i, "rows": i * 10}) if i != 2 else "{half")
        (folder / "plan.json").write_text(json.dumps({"molecule_id": str(i), "shards": [[0, i]]}))
    (tmp_path / "_SUCCESS").write_text('{"status": "done"}')
    (tmp_path / "molecule_id=9").mkdir()
    (tmp_path / "molecule_id=9" / "_SUCCESS").write_text("[]")
    return tmp_path


def test_batch(spark, build):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(MarkerSource)
    rows = {r.path.removeprefix(str(build)): r for r in spark.read.format("build_markers").load(str(build)).collect()}
    assert set(rows) == {"/_SUCCESS", "/molecule_id=9/_SUCCESS", *(f"/molecule_id={i}/deep/_SUCCESS" for i in range(4))}
    assert rows["/molecule_id=2/deep/_SUCCESS"].broken and rows["/molecule_id=2/deep/_SUCCESS"].molecule_id == "2"
    assert rows["/molecule_id=9/_SUCCESS"].broken and rows["/_SUCCESS"].molecule_id is None and rows["/_SUCCESS"].status == "done"
    plans = spark.read.format("build_markers").option("name", "plan.json").load(str(build)).select("molecule_id", F.from_json("record", "shards array<array<int>>").alias("p"))
    assert {r.molecule_id: r.p.shards for r in plans.collect()} == {str(i): [[0, i]] for i in range(4)}
    assert spark.read.format("build_markers").load(str(build / "none")).collect() == []


def test_filters_open_only_the_folders_asked_for(build):
    reader = markers._Reader(str(build), "_SUCCESS")
    asked = [markers.EqualTo(("molecule_id",), "1")]
    assert list(reader.pushFilters(asked)) == asked
    assert [p.path.rsplit("/", 1)[1] for p in reader.partitions()][1:] == ["molecule_id=1"]


def test_stream_brings_each_marker_once(spark, build, tmp_path_factory, monkeypatch):
    monkeypatch.setattr(markers, "BEHIND", 0.0)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(MarkerSource)
    out, check = (str(tmp_path_factory.mktemp("stream") / x) for x in ("out", "check"))

    def drain():
        stream = spark.readStream.format("build_markers").load(str(build)).writeStream.format("parquet").option("checkpointLocation", check)
        query = stream.trigger(processingTime="1 second").start(out)
        time.sleep(6)
        query.stop()
        return sorted(r.path for r in spark.read.parquet(out).collect())

    assert len(drain()) == 6
    (build / "molecule_id=7").mkdir()
    (build / "molecule_id=7" / "_SUCCESS").write_text('{"status": "success"}')
    found = drain()
    assert len(found) == len(set(found)) == 7

import pytest
from pyspark.sql import types as T

from fragmill.sources import readers, sinks

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


@pytest.fixture
def build(spark, tmp_path):
    for m in range(3):
        spark.createDataFrame([(m * 10 + i, f"n{i}") for i in range(4)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/molecule_id={m}"))
    (tmp_path / "in/molecule_id=9").mkdir()
    (tmp_path / "in/molecule_id=9/chunk_bad.parquet").write_bytes(b"PAR1 no more")
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "in/molecule_id=8"))  # no column name
    files = readers.files(spark, str(tmp_path / "in"), "*.parquet")
    return tmp_path, files.withColumn("molecule_id", readers.path_molecule(files["path"]))


def test_failures_limits_and_ledger(spark, build):
    tmp_path, listing = build
    ledger, target = str(tmp_path / "ledger"), str(tmp_path / "out")
    run = lambda **options: tuple(sinks.import_files(spark, listing, ledger, target, SCHEMA, **options))
    assert run(dry_run=True)[:3] == (0, 0, 0)
    assert run()[:3] == (0, 0, 2)
    assert run(limit_molecules=2)[:3] == (2, 0, 0)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 10, 11, 12, 13]
    found = run(continue_on_error=True)
    assert found[:3] == (1, 2, 2) and {r.path.split("/")[-2] for r in found[3].collect()} == {"molecule_id=8", "molecule_id=9"}
    assert spark.read.parquet(target).count() == 12
    assert run(limit_files=1)[:3] == (0, 1, 0) and run(limit_files=0)[:3] == (0, 0, 0)
    assert run(limit_molecules=1, reimport=True)[:3] == (1, 0, 0) and spark.read.parquet(target).count() == 16
    with pytest.raises(ValueError, match="negative"):
        run(limit_files=-1)

import datetime as dt

import pytest

from fragmill.functions import scalars
from fragmill.operators import audit, dialogue, fragments, graph, ranking, semantics, telemetry, warehouse
from fragmill.sources import readers, sinks
from pyspark.sql import functions as F


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "headers,query,path,body,want",
    [
        ({"X-User-Id": "42"}, "user_id=17", "/users/23", '{"user_id": 31}', ("42", "header:x-user-id")),
        ({"a": "b"}, "p=1&user_id=17", "/users/23", '{"user_id": 31}', ("17", "query:user_id")),
        ({"a": "b"}, "", "/api/users/23/x", '{"user_id": 31}', ("23", "path")),
        ({"Content-Type": "application/json; charset=utf-8"}, "", "/api", '{"userId": 31}', ("31", "json:userId")),
        ({"content-type": "application/json"}, "", "/api", '{"user_id": "  ", "userId": true}', ("True", "json:userId")),
        ({"content-type": "application/json"}, "", "/api", '{"user_id": 1.5}', (None, None)),
        ({"content-type": "application/json"}, "", "/api", "{broken", (None, None)),
        ({"a": "b"}, "", "/api", '{"userId": 31}', (None, None)),
        ({"content-type": "application/x-www-form-urlencoded"}, "", "/api", "a=1&user_id=8%2B", ("8+", "form:user_id")),
        ({"x-authenticated-user-id": " 5 "}, "userId=7", "/api", "", ("5", "header:x-authenticated-user-id")),
        ({"x-userid": "5"}, "userId=" + "7" * 300, "/api", "", ("7" * 256, "query:userId")),
        ({"a": "b"}, "", "/api", "", (None, None)),
    ],
)
def test_identity_precedence(spark, headers, query, path, body, want):
    m = F.create_map(*[F.lit(x) for kv in headers.items() for x in kv])
    got = spark.range(1).select(audit.identity(m, F.lit(query), F.lit(path), F.lit(body)).alias("i")).first()["i"]
    assert (got["user_id"], got["user_id_source"]) == want


def test_masking_reaches_all_depths(spark):
    text = '{"a": {"Password": "x\\"y", "n": 1}, "api_key":12, "list":[{"token":"t"}], "name":"token"}'
    got = spark.range(1).select(audit.masked(F.lit(text)).alias("x")).first()["x"]
    assert got == '{"a":{"Password":"***","n":1},"api_key":"***","list":[{"token":"***"}],"name":"token"}'
    for same in ('{"max_tokens":5}', "no json, token", '{"note":"secret"}'):
        assert spark.range(1).select(audit.masked(F.lit(same)).alias("x")).first()["x"] == same
    whole = '{"token":{"a":"s3cret"},"secret":["a",{"b":1}]}'
    assert spark.range(1).select(audit.masked(F.lit(whole)).alias("x")).first()["x"] == '{"token":"***","secret":"***"}'


def test_states_merge_to_one_shot(spark):
    rows = [(f"m{i % 5}", f"h{i % 7}", f"s{i % 7}", i % 7, i % 7 - 1, i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "molecule_id string, fragment_hash string, canonical_smiles string, atom_count int, bond_count int, batch int")
    once, twice = warehouse.states(df), warehouse.merged(warehouse.states(df, "batch"))
    assert warehouse.differences(once, twice).count() == 0


def units(spark, *molecules):
    rows = [(m, u, a) for m, us in molecules for u, atoms in enumerate(us) for a in atoms]
    return spark.createDataFrame(rows, "molecule_id string, unit int, atom int")


def test_enumeration_is_complete(spark):
    ring = [(i, (i + 1) % 6) for i in range(6)]
    chain = [(0, 1), (1, 2), (2, 3), (3, 4, 5, 6, 7, 8)]
    systems = spark.createDataFrame([("phenethylamine", 3), ("benzene", 0)], "molecule_id string, unit int")
    found = fragments.enumerated(units(spark, ("cyclohexane", ring), ("phenethylamine", chain), ("benzene", [tuple(range(6))])), 10, systems)
    counts = {r.molecule_id: r["count"] for r in found.groupBy("molecule_id").count().collect()}
    # All connected bond sets of a six-ring; what touches an aromatic system holds all of it.
    assert counts == {"cyclohexane": 31, "phenethylamine": 7, "benzene": 1}
    assert all(len(r.atoms) == len(set(r.atoms)) for r in found.collect())
    small = fragments.enumerated(units(spark, ("m", ring)), 3)
    assert sorted(len(r.units) for r in small.collect()) == [1] * 6 + [2] * 6


def test_formulas(spark):
    found = fragments.enumerated(units(spark, ("ether", [(0, 1), (1, 2)])), 3)
    atoms = spark.createDataFrame([("ether", 0, "C"), ("ether", 1, "O"), ("ether", 2, "C")], "molecule_id string, atom int, label string")
    assert sorted(r.formula for r in fragments.labelled(found, atoms).collect()) == ["C O", "C O", "C2 O"]


def test_subsets_of_residues_go(spark):
    parts = spark.createDataFrame([("m", [1, 2]), ("m", [1, 9]), ("m", [1, 2, 3]), ("n", [1, 2])], "molecule_id string, atoms array<int>")
    residues = spark.createDataFrame([("m", [1, 2, 3])], "molecule_id string, atoms array<int>")
    assert sorted(map(tuple, (r.atoms for r in fragments.not_within(parts, residues, "molecule_id").collect()))) == [(1, 2), (1, 2, 3), (1, 9)]


def test_candidates_are_resolved(spark):
    columns = "molecule_id string, atoms array<int>, smiles string, kind string, priority int, is_protected boolean, is_complete_residue boolean, heavy_atoms int, rings int, carbons int"
    rows = [
        ("m", [1, 2, 3, 4], "NCCO", "amino_acid_residue", 1000, True, True, 4, 0, 2),
        ("m", [1, 2, 3], "NCC", "path", 450, False, False, 3, 0, 2),
        ("m", [1, 2, 4], "NCO", "drug_feature_rule", 920, False, False, 3, 0, 1),
        ("m", [5, 6, 7], "CCC", "path", 450, False, False, 3, 0, 3),
        ("m", [5, 6], "CO", "functional_group", 650, False, False, 2, 0, 1),
        ("m", [5, 6, 8], "CCO", "path", 450, False, False, 3, 0, 2),
        ("m", [5, 6, 8], "CCO", "functional_group", 650, False, False, 3, 0, 2),
        ("m", [9, 10, 11], "CCO", "path", 450, False, False, 3, 0, 2),
    ]
    got = sorted((r.smiles, r.kind) for r in semantics.resolved(spark.createDataFrame(rows, columns)).collect())
    assert got == [("CCO", "functional_group"), ("NCCO", "amino_acid_residue"), ("NCO", "drug_feature_rule")]


def test_containment_join_loses_no_pair(spark):
    names = spark.createDataFrame([("Aspirin Plus",), ("",), (None,), ("xin",), ("Ünlü",), ("aaaa",)], "name string")
    terms = spark.createDataFrame([("in",), ("PIR",), ("x",), ("",), ("nlü",), ("aa",), ("aspirin plus",)], "term string")
    got = {(r.name, r.term) for r in graph.containing(names, "name", terms, "term").collect()}
    want = {(n.name, t.term) for n in names.collect() for t in terms.collect() if t.term and t.term.lower() in (n.name or "").lower()}
    assert got == want


def test_pages_and_filters_check_arguments(spark):
    with pytest.raises(ValueError):
        graph.page(spark.range(3), ["id"], limit=2001)
    with pytest.raises(ValueError):
        dialogue.matching(conclusion=5)
    with pytest.raises(ValueError):
        dialogue.matching(since=dt.datetime(2024, 1, 2), until=dt.datetime(2024, 1, 1))


def test_review_status(spark):
    rows = [("a", None, None, []), ("b", 1, None, []), ("c", None, "x", None), ("d", None, None, ["u"])]
    df = spark.createDataFrame(rows, "status string, judge_conclusion int, judge_content string, attachments array<string>")
    assert [r.status for r in dialogue.reviewed(df, "done").collect()] == ["a", "done", "done", "done"]


def test_numeric_first_order(spark):
    df = spark.createDataFrame([("b",), ("10",), ("9",), ("a",)], "i string")
    assert [r.i for r in df.orderBy(*telemetry.numeric_first("i")).collect()] == ["9", "10", "a", "b"]


def test_numbers_run_over_all_ranges(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("id", "5000 - id AS k")
    got = ranking.numbered(df, [F.col("k")], "n")
    assert got.columns == ["id", "k", "n"] and got.where("n <> k").count() == 0 and got.count() == 5000
    assert [tuple(r) for r in sinks.report(df.limit(3), ["id"], "k").orderBy("id").collect()] == [(0, 5000, 1), (1, 4999, 1), (2, 4998, 1)]


def test_last_rows(spark):
    rows = [("a", 1, None), ("a", 3, "x"), ("b", None, "y"), (None, 2, "z"), ("a", 2, "w")]
    got = ranking.last(spark.createDataFrame(rows, "k string, t int, v string"), ["k"], ["t"]).collect()
    assert sorted(map(tuple, got), key=repr) == [("a", 3, "x"), ("b", None, "y"), (None, 2, "z")]


def test_scalars(spark):
    import hashlib

    row = spark.range(1).select(
        scalars.split_trimmed(F.lit(" a ;; b;")).alias("a"), scalars.path_molecule(F.lit("/x/molecule_id=7/chunk_1.parquet")).alias("b"),
        scalars.build_of(F.lit("/d/build_1/build_2/x")).alias("c"), scalars.json_list(F.lit("bad")).alias("d"), scalars.is_phone(F.lit("13812345678")).alias("e"),
        scalars.blake2b(128)(F.lit("CCO")).alias("f"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e) == (["a", "b"], "7", "build_2", [], True)
    assert row.f == hashlib.blake2b(b"CCO", digest_size=16).hexdigest()
    assert [scalars.column_at(["A1", "x", "y"], p) for p in ("X", "3", "a")] == ["x", "y", "A1"]
    assert scalars.quoted("a`b") == "`a``b`"


def test_sources_and_sinks(spark, tmp_path):
    source = tmp_path / "m.csv"
    source.write_text("﻿molecule_id,smiles\n1, CCO \n2,\n", encoding="utf-8")
    assert [tuple(r) for r in readers.molecules(spark, str(source), strict=False).collect()] == [("1", "CCO")]
    with pytest.raises(Exception, match="without an id or a SMILES"):
        readers.molecules(spark, str(source)).collect()
    rows = spark.createDataFrame([("1", "CCO", 3, 2), ("2", "CC", 2, 1)], "molecule_id string, canonical_smiles string, atom_count int, bond_count int")
    sinks.write_fragments(rows, str(tmp_path / "build"))
    manifest = sinks.checksums(spark, str(tmp_path / "build"))
    assert manifest.count() == 2 and sinks.broken(manifest, manifest.limit(1)).count() == 1
    folder = tmp_path / "b" / "molecule_id=5"
    folder.mkdir(parents=True)
    (folder / "_SUCCESS").write_text('{"status": "success", "fragment_rows": 12}')
    marks = readers.success_markers(spark, str(tmp_path / "b")).collect()
    assert [(m.molecule_id, m.status, m.fragment_rows, m.broken) for m in marks] == [("5", "success", 12, False)]


def test_imports_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    listing = readers.files(spark, str(tmp_path / "in"), "*.parquet")
    run = lambda: sinks.import_new(spark, listing, str(tmp_path / "ledger"), str(tmp_path / "out"), ["id"])
    n = listing.count()
    assert run() == (n, 0) and run() == (0, n)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_compacted_states_are_the_same(spark, tmp_path):
    from fragmill.streaming import ingest

    rows = spark.createDataFrame([(f"m{i % 3}", "h", "s", 1, 0) for i in range(30)], "molecule_id string, fragment_hash string, canonical_smiles string, atom_count int, bond_count int")
    rows.write.parquet(str(tmp_path / "landing"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "landing"))
    got = ingest.appended_states(stream, str(tmp_path / "w"))
    again = spark.read.parquet(ingest.compacted(spark, str(tmp_path / "w")))
    assert warehouse.differences(got, warehouse.states(rows)).count() == 0 == warehouse.differences(again, got).count()


def test_events_count_once_and_late_ones_are_left_out(spark, tmp_path):
    from fragmill.streaming import ingest

    def rows(*events):
        return spark.createDataFrame(events, "event_id long, ts string, event_type string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1)

    rows((1, "2024-01-05 10:00:00", "a"), (2, "2024-01-05 11:00:00", "a"), (2, "2024-01-05 11:00:00", "a")).write.parquet(str(tmp_path / "in/1"))
    rows((3, "2024-01-20 10:00:00", "a"), (1, "2024-01-20 10:00:00", "b")).write.parquet(str(tmp_path / "in/2"))
    rows((5, "2024-01-19 12:00:00", "a")).write.parquet(str(tmp_path / "in/3"))
    rows((4, "2024-01-05 12:00:00", "a")).write.parquet(str(tmp_path / "in/4"))
    stream = spark.readStream.schema("event_id long, ts timestamp, event_type string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    got = {(str(r.start)[:10], r.event_type): r.n for r in ingest.counted_by_day(stream, str(tmp_path), "2 days").collect()}
    assert got[("2024-01-05", "a")] == 2 and got[("2024-01-19", "a")] == 1 and got[("2024-01-20", "a")] == 1


def test_reports_of_a_build(spark, tmp_path):
    rows = [("1", "success", 5, 1.0, None), ("2", "failed", None, 0.5, "boom"), ("3", "skipped", None, None, None)]
    df = spark.createDataFrame(rows, "molecule_id string, status string, fragment_rows long, elapsed_seconds double, error string")
    sinks.write_reports(df, str(tmp_path))
    assert [r.asDict() for r in spark.read.json(f"{tmp_path}/failed_molecules").collect()] == [{"error": "boom", "molecule_id": "2"}]
    summary = spark.read.json(f"{tmp_path}/build_summary").first().asDict()
    assert summary == {"total": 3, "success": 1, "skipped": 1, "failed": 1, "fragment_rows": 5, "elapsed_seconds": 1.5}


def test_a_large_molecule_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(1000).selectExpr("if(id < 900, 'big', 'small') as molecule_id", "sha2(string(id), 256) as fragment_hash", "int(id % 9) as atom_count", "int(id % 9) as bond_count")
    sinks.write_fragments(rows, str(tmp_path / "f"), rows_per_file=100)
    files = {r.file: r.n for r in readers.rows_by_file(spark, str(tmp_path / "f")).collect()}
    assert sum(files.values()) == 1000 and sum("=big" in f for f in files) >= 5 and max(files.values()) <= 100


def test_masks_wider_than_a_number(spark):
    rows = spark.createDataFrame([(1, [0, 4, 70]), (2, []), (3, [3, 3])], "id int, bits array<int>")
    got = {r["id"]: r["m"] for r in rows.select("id", scalars.mask_hex(F.col("bits")).alias("m")).collect()}
    assert got == {1: format(1 | 1 << 4 | 1 << 70, "x"), 2: "0", 3: "8"}


def test_views_over_views_and_views_in_a_ring(spark):
    rows = warehouse.with_views(spark, "SELECT sum(x) AS s FROM {b}", a="SELECT id + 1 AS x FROM {base}", b="SELECT x * 2 AS x FROM {a}", base=spark.range(3))
    assert rows.collect() == [(12,)]
    with pytest.raises(ValueError):
        warehouse.with_views(spark, "SELECT * FROM {a}", a="SELECT * FROM {b}", b="SELECT * FROM {a}")


def test_parts_that_nothing_covers(spark):
    atoms = spark.createDataFrame([(1, i) for i in range(6)] + [(2, 0), (3, 0)], "molecule_id int, atom int")
    bonds = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 3), (1, 3, 4)], "molecule_id int, a int, b int")
    got = fragments.uncovered_parts(atoms, bonds, spark.createDataFrame([(1, 2), (3, 0)], "molecule_id int, atom int"))
    assert sorted((r[0], r[1]) for r in got.collect()) == [(1, [0, 1]), (1, [3, 4]), (1, [5]), (2, [0])]


def test_requests_without_types_or_limits_are_refused(spark):
    rows = spark.createDataFrame([(1, "Drug", "Gene", 2, 3), (2, None, "Gene", 2, 3), (3, "Drug", "Gene", 0, 3), (4, "Drug", "Gene", None, 3), (5, "a", "b", 1, 1)], "n int, source_type string, aim_type string, max_jump_num int, max_path_num int")
    recorded, refused = audit.path_requests(rows, ["n"])
    assert sorted((r["n"], r["id"]) for r in recorded.collect()) == [(1, 1), (5, 2)]
    assert sorted((r["n"], r["error"].split()[0]) for r in refused.collect()) == [(2, "source_type"), (3, "max_jump_num"), (4, "max_jump_num")]


def test_nodes_that_are_null_have_no_payload(spark):
    rows = spark.sql("SELECT array('b', 'a') AS l, map('x', '1') AS p UNION ALL SELECT NULL, NULL")
    got = rows.select(graph.payload(F.col("l"), F.col("p")).alias("n")).collect()
    assert {(tuple(r["n"]["labels"]) if r["n"] else None) for r in got} == {("a", "b"), None}


def test_records_too_deep_or_too_large_are_masked_whole(spark):
    from fragmill.operators import audit

    texts = ["[" * 100_000 + '{"password": 1}' + "]" * 100_000, '{"token": "a", "n": 1e999}', '{"token": "a", "n": [1.5, {"Secret": []}]}', "password=1"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(audit.masked(F.col("t")).alias("t")).collect()
    assert [r.t for r in rows] == ["***", "***", '{"token":"***","n":[1.5,{"Secret":"***"}]}', "password=1"]

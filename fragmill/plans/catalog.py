"""All queries over the given tables, by name, and the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fragmill.functions import canonical, scalars, smiles
from fragmill.operators import audit, dialogue, fragments, graph, maintained, matching, patterns, ranking, semantics, skeletons, split, telemetry, warehouse
from fragmill.plans.analogues import CORES, Tables, with_views
from fragmill.session import settled
from fragmill.sources import readers, sinks
from fragmill.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None, *views: str, recursive: bool = False):
    """Registers a function of Tables under its name, with its SQL."""

    def register(function: Callable[[Tables], DataFrame]):
        _QUERIES[function.__name__] = lambda spark, folder: function(Tables(spark, folder))
        if sql:
            _SQL[function.__name__] = with_views(sql, *views, recursive=recursive) if views else sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_CARRIED = "min(canonical_smiles) AS canonical_smiles, min(atom_count) AS atom_count, min(bond_count) AS bond_count"

# Fragment warehouse


@_query("SELECT count(DISTINCT canonical_smiles) AS n FROM fragments WHERE canonical_smiles <> ''", "fragments")
def a01_distinct_smiles_count(t: Tables) -> DataFrame:
    return warehouse.non_blank(t.fragments()).agg(F.count_distinct("canonical_smiles").alias("n"))


@_query("SELECT DISTINCT canonical_smiles FROM fragments WHERE canonical_smiles <> ''", "fragments")
def a02_distinct_smiles(t: Tables) -> DataFrame:
    return warehouse.non_blank(t.fragments()).select("canonical_smiles").distinct().orderBy("canonical_smiles")


@_query(f"SELECT molecule_id, fragment_hash, {_CARRIED}, count(*) AS occurrence_count FROM small GROUP BY 1, 2", "small")
def a03_small_fragments(t: Tables) -> DataFrame:
    return warehouse.states(t.small()).orderBy(F.col("occurrence_count").desc())


@_query(f"SELECT molecule_id, fragment_hash, batch, {_CARRIED}, count(*) AS occurrence_count FROM big GROUP BY 1, 2, 3", "big")
def a04_partial_states(t: Tables) -> DataFrame:
    return warehouse.states(t.big(), "batch")


@_query(f"SELECT molecule_id, fragment_hash, {_CARRIED}, count(*) AS occurrence_count FROM big GROUP BY 1, 2", "big")
def a05_merged_states(t: Tables) -> DataFrame:
    return warehouse.merged(warehouse.states(t.big(), "batch"))


@_query(f"SELECT molecule_id, fragment_hash, {_CARRIED}, count(*) AS occurrence_count FROM big GROUP BY 1, 2", "big")
def t01_streamed_states(t: Tables) -> DataFrame:
    return ingest.streamed_states(t)


_OF = """SELECT molecule_id, fragment_hash, min(ingredient_name) AS ingredient_name, {carried}, count(*) AS occurrence_count, '{b}' AS source
  FROM {b} JOIN {i} USING (molecule_id) WHERE ingredient_name = 'NATION_15' GROUP BY 1, 2"""


@_query(" UNION ALL ".join(_OF.format(b=b, i="ingredients", carried=_CARRIED) for b in ("small", "big")), "small", "big", "ingredients")
def u01_unified_fragments(t: Tables) -> DataFrame:
    rows = warehouse.of_ingredient(t.small(), warehouse.states(t.big(), "batch"), t.ingredients(), "NATION_15")
    return rows.orderBy("molecule_id", "atom_count", "canonical_smiles")


@_query(
    f"""SELECT molecule_id, fragment_hash, {_CARRIED}, count(*) AS occurrence_count, ingredient_name, 'small' AS source
    FROM small LEFT JOIN ingredients USING (molecule_id) GROUP BY molecule_id, fragment_hash, ingredient_name
    UNION ALL SELECT molecule_id, fragment_hash, {_CARRIED}, count(*), ingredient_name, 'big'
    FROM big LEFT JOIN ingredients USING (molecule_id) GROUP BY molecule_id, fragment_hash, ingredient_name""",
    "small", "big", "ingredients",
)
def u02_all_unique(t: Tables) -> DataFrame:
    return warehouse.all_unique(t.small(), warehouse.states(t.big(), "batch"), t.ingredients())


@_query(
    f"""SELECT molecule_id, fragment_hash, {_CARRIED}, count(*) AS occurrence_count FROM small JOIN ingredients_twice USING (molecule_id)
    WHERE ingredient_name LIKE 'NATION_1%' GROUP BY 1, 2""",
    "small", "ingredients_twice",
)
def j01_join_before_aggregate(t: Tables) -> DataFrame:
    names = t.ingredients_twice().where(F.col("ingredient_name").startswith("NATION_1"))
    return warehouse.states(t.small().join(names, "molecule_id"))


@_query("SELECT molecule_id, canonical_smiles, ingredient_name FROM big LEFT JOIN ingredients USING (molecule_id) WHERE ingredient_name = 'NATION_3'", "big", "ingredients")
def j02_left_join_null_rejecting(t: Tables) -> DataFrame:
    rows = warehouse.with_ingredients(t.big(), t.ingredients()).where("ingredient_name = 'NATION_3'")
    return rows.select("molecule_id", "canonical_smiles", "ingredient_name")


@_query("SELECT molecule_id, fragment_hash, canonical_smiles, coalesce(ingredient_name, '') AS ingredient_name FROM small LEFT JOIN (SELECT DISTINCT * FROM ingredients_twice WHERE molecule_id NOT LIKE '1%') USING (molecule_id)", "small", "ingredients_twice")
def j03_blank_for_missing(t: Tables) -> DataFrame:
    names = t.ingredients_twice().where(~F.col("molecule_id").startswith("1"))
    rows = warehouse.with_ingredients(t.small(), names, blank=True, dedupe=True)
    return rows.select("molecule_id", "fragment_hash", "canonical_smiles", "ingredient_name")


@_query(
    """m AS (SELECT molecule_id, batch, count(*) AS n FROM big GROUP BY 1, 2)
    SELECT molecule_id, batch, n, 'old' AS version FROM m WHERE batch % 2 = 0
    UNION ALL SELECT molecule_id, batch, n + 1, 'new' FROM m WHERE batch % 2 = 1""",
    "big",
)
def d08_upsert(t: Tables) -> DataFrame:
    rows = t.big().groupBy("molecule_id", "batch").agg(F.count("*").alias("n"))
    new = rows.where("batch % 2 = 1").withColumn("n", F.col("n") + 1).withColumn("version", F.lit("new"))
    return warehouse.upserted(rows.withColumn("version", F.lit("old")), new, ["molecule_id", "batch"])


@_query(
    """k AS (SELECT DISTINCT molecule_id, batch FROM big), n AS (SELECT molecule_id FROM k WHERE batch = 1995)
    SELECT molecule_id, batch, CAST(NULL AS VARCHAR) AS added FROM k WHERE molecule_id NOT IN (SELECT molecule_id FROM n)
    UNION ALL SELECT molecule_id, 9999, 'yes' FROM n""",
    "big",
)
def d09_versions_and_added_columns(t: Tables) -> DataFrame:
    old = t.big().select("molecule_id", "batch").distinct()
    new = old.where("batch = 1995").select("molecule_id", F.lit(9999).alias("batch"), F.lit("yes").alias("added"))
    return warehouse.replaced_version(old.withColumn("added", F.lit(None).cast("string")), new, ["molecule_id"])


@_query(
    """(SELECT canonical_smiles, 'left' AS side FROM (SELECT canonical_smiles FROM small EXCEPT ALL SELECT canonical_smiles FROM big))
    UNION ALL (SELECT canonical_smiles, 'right' FROM (SELECT canonical_smiles FROM big EXCEPT ALL SELECT canonical_smiles FROM small))""",
    "small", "big",
)
def u03_differences(t: Tables) -> DataFrame:
    return warehouse.differences(t.small().select("canonical_smiles"), t.big().select("canonical_smiles"))


@_query("SELECT atom_count, bond_count, canonical_smiles, fragment_hash FROM fragments WHERE atom_count BETWEEN 8 AND 12 GROUP BY ALL", "fragments")
def p15_atom_range(t: Tables) -> DataFrame:
    rows = t.fragments().where(F.col("atom_count").between(8, 12))
    return rows.select("atom_count", "bond_count", "canonical_smiles", "fragment_hash").distinct().orderBy("atom_count", "canonical_smiles")


@_query("SELECT CAST(l_suppkey AS VARCHAR) AS molecule_id, count(*) AS fragments FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def o10_top_molecules(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").groupBy(F.col("l_suppkey").cast("string").alias("molecule_id")).agg(F.count("*").alias("fragments"))
    return rows.orderBy(F.col("fragments").desc(), "molecule_id").limit(10)


@_query("SELECT molecule_id, row_number() OVER (ORDER BY CAST(molecule_id AS INT)) AS place FROM (SELECT DISTINCT molecule_id FROM fragments)", "fragments")
def o06_numeric_first(t: Tables) -> DataFrame:
    return ranking.numbered(t.fragments().select("molecule_id").distinct(), telemetry.numeric_first("molecule_id"), "place")


# Dialogues and reviews


@_query("SELECT u.user_id, count(t.turn_id) AS turn_count FROM users u LEFT JOIN (SELECT * FROM dialogues WHERE NOT is_deleted) d USING (user_id) LEFT JOIN turns t USING (dialogue_id) GROUP BY 1", "users", "dialogues", "turns")
def j07_turns_of_all_users(t: Tables) -> DataFrame:
    return dialogue.turn_counts(t.users(), t.dialogues(), t.turns())


@_query("SELECT u.user_id, count(t.turn_id) AS turn_count FROM users u LEFT JOIN dialogues d USING (user_id) LEFT JOIN turns t USING (dialogue_id) WHERE NOT is_deleted GROUP BY 1", "users", "dialogues", "turns")
def j06_turns_where_live(t: Tables) -> DataFrame:
    return dialogue.turn_counts_where(t.users(), t.dialogues(), t.turns())


@_query("SELECT dialogue_id, title, count(turn_id) AS n, coalesce(string_agg(turn_no || ':' || kind, ',' ORDER BY turn_no, kind, turn_id), '') AS turns FROM dialogues LEFT JOIN turns USING (dialogue_id) GROUP BY 1, 2", "dialogues", "turns")
def j15_nested_turns(t: Tables) -> DataFrame:
    rows = dialogue.nested(t.dialogues(), t.turns(), "dialogue_id", "turn_no", ["turn_no", "kind", "turn_id"], "turns")
    line = F.array_join(F.transform("turns", lambda x: F.concat_ws(":", x["turn_no"], x["kind"])), ",")
    return rows.select("dialogue_id", "title", F.size("turns").cast("long").alias("n"), line.alias("turns"))


@_query("SELECT t.turn_id, d.user_id, r.status, r.judge_conclusion FROM reviews r JOIN turns t ON r.doc_id = t.turn_id JOIN dialogues d USING (dialogue_id)", "reviews", "turns", "dialogues")
def j05_reviews_of_users(t: Tables) -> DataFrame:
    rows = t.reviews().withColumnRenamed("doc_id", "turn_id").join(t.turns(), "turn_id").join(t.dialogues(), "dialogue_id")
    return rows.select("turn_id", "user_id", rows["status"], "judge_conclusion")


@_query("SELECT d.doc_id, l.quality AS review, l.doc_id IS NOT NULL AS review_added FROM documents d LEFT JOIN labels l USING (doc_id)")
def j14_review_flags(t: Tables) -> DataFrame:
    rows = dialogue.flagged(t.raw("documents").select("doc_id"), t.raw("labels").withColumnRenamed("quality", "review"), ["doc_id"], "review_added", "review")
    return rows.select("doc_id", "review", "review_added")


@_query("""SELECT conv_id, turn, text AS question, CASE WHEN r2 = 'assistant' THEN t2 END AS answer FROM (
    SELECT *, lead(role) OVER w AS r2, lead(text) OVER w AS t2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) WHERE role = 'user'""")
def j04_questions_and_answers(t: Tables) -> DataFrame:
    return dialogue.paired(t.raw("conversations"))


@_query("SELECT doc_id, status, judge_conclusion, comment FROM reviews WHERE status = 'done' AND judge_conclusion = 1 AND (question ILIKE '%idiot%' OR answer ILIKE '%idiot%' OR comment ILIKE '%idiot%')", "reviews")
def p09_review_filter(t: Tables) -> DataFrame:
    rows = dialogue.filtered(t.reviews(), dialogue.matching(status="done", conclusion=1, keyword="idiot"))
    return rows.select("doc_id", "status", "judge_conclusion", "comment")


@_query("SELECT dialogue_id, title FROM dialogues WHERE updated_at >= TIMESTAMP '1996-01-01' AND updated_at <= TIMESTAMP '1996-12-31' AND title ILIKE '%urgent%'", "dialogues")
def f25_time_range(t: Tables) -> DataFrame:
    found = dialogue.matching(since=dt.datetime(1996, 1, 1), until=dt.datetime(1996, 12, 31), keyword="urgent", columns=("title",))
    return dialogue.filtered(t.dialogues(), found).select("dialogue_id", "title")


@_query("SELECT doc_id, CASE WHEN judge_conclusion = 0 AND comment = 'en' THEN status ELSE 'checked' END AS status FROM reviews", "reviews")
def p20_review_status(t: Tables) -> DataFrame:
    rows = t.reviews().withColumn("judge_conclusion", F.nullif("judge_conclusion", F.lit(0)))
    rows = rows.withColumn("judge_content", F.when(F.col("comment") != "en", F.col("comment"))).withColumn("attachments", F.array().cast("array<string>"))
    return dialogue.reviewed(rows, "checked").select("doc_id", "status")


@_query("SELECT user_id, CASE WHEN n = 1 THEN segment ELSE segment || (n - 1) END AS name FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY user_id) AS n FROM users)", "users")
def w07_unique_names(t: Tables) -> DataFrame:
    return dialogue.unique_names(t.users(), "segment", "user_id", "name").select("user_id", "name")


@_query("SELECT greatest(1000, coalesce(max(user_id), 0) + 1) AS next_number FROM users", "users")
def a09_next_number(t: Tables) -> DataFrame:
    return dialogue.next_number(t.users(), "user_id", 1000)


@_query("SELECT user_id, username FROM users WHERE username BETWEEN 'Customer#000000100' AND 'Customer#000000199' OR user_id IN (1, 7, 9)", "users")
def p11_key_lookups(t: Tables) -> DataFrame:
    named = F.col("username").between("Customer#000000100", "Customer#000000199")
    return t.users().where(named | F.col("user_id").isin(1, 7, 9)).select("user_id", "username")


@_query("SELECT DISTINCT user_id FROM users SEMI JOIN (SELECT user_id FROM dialogues WHERE NOT is_deleted AND title = '1-URGENT') d USING (user_id)", "users", "dialogues")
def p13_existence(t: Tables) -> DataFrame:
    live = t.dialogues().where("not is_deleted and title = '1-URGENT'")
    return t.users().join(live, "user_id", "left_semi").select("user_id")


@_query("SELECT 'turns without a dialogue' AS rule, count(*) AS broken FROM turns ANTI JOIN dialogues USING (dialogue_id) UNION ALL SELECT 'turns twice', coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM turns GROUP BY turn_id) UNION ALL SELECT 'dialogues without a user', count(*) FROM dialogues ANTI JOIN users USING (user_id)", "turns", "dialogues", "users")
def d02_constraints(t: Tables) -> DataFrame:
    count = lambda rows, rule: rows.agg(F.count("*").alias("broken")).select(F.lit(rule).alias("rule"), "broken")
    twice = t.turns().groupBy("turn_id").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("broken"))
    return (
        count(t.turns().join(t.dialogues(), "dialogue_id", "left_anti"), "turns without a dialogue")
        .unionByName(twice.select(F.lit("turns twice").alias("rule"), "broken"))
        .unionByName(count(t.dialogues().join(t.users(), "user_id", "left_anti"), "dialogues without a user"))
    )


# Graph enrichment


_TERMS = "terms AS (SELECT DISTINCT substr(p_brand, 7) AS term FROM part UNION SELECT DISTINCT string_split(p_name, ' ')[1] FROM part)"


def _terms(t: Tables) -> DataFrame:
    part = t.raw("part")
    return part.select(F.expr("substr(p_brand, 7)").alias("term")).union(part.select(F.split("p_name", " ")[0].alias("term"))).distinct()


@_query(f"WITH {_TERMS} SELECT term, p_partkey FROM part JOIN terms ON term <> '' AND contains(lower(p_name), lower(term))")
def j08_names_containing(t: Tables) -> DataFrame:
    return graph.containing(t.raw("part").select("p_partkey", "p_name"), "p_name", _terms(t), "term").select("term", "p_partkey")


_EDGES = "SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst, 'MADE_BY' AS type FROM lineitem UNION SELECT 's' || s_suppkey, 'n' || s_nationkey, 'IN' FROM supplier"


def _edges(t: Tables) -> DataFrame:
    made = t.raw("lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.lit("MADE_BY").alias("type"))
    placed = t.raw("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("src"), F.concat(F.lit("n"), "s_nationkey").alias("dst"), F.lit("IN").alias("type"))
    return made.unionByName(placed).distinct()


@_query(f"WITH e AS ({_EDGES}), b AS (SELECT src, dst, type FROM e UNION ALL SELECT dst, src, type FROM e) SELECT p_partkey, coalesce(string_agg(DISTINCT dst, ',' ORDER BY dst), '') AS makers FROM part LEFT JOIN b ON src = 'p' || p_partkey AND type = 'MADE_BY' GROUP BY 1")
def j09_one_hop(t: Tables) -> DataFrame:
    nodes = t.raw("part").select("p_partkey", F.concat(F.lit("p"), "p_partkey").alias("node"))
    rows = graph.gathered(graph.hop(nodes, _edges(t), "MADE_BY", "node", "maker"), ["p_partkey"], "maker", "makers")
    return rows.withColumn("makers", F.array_join("makers", ","))


@_query(f"WITH e AS ({_EDGES}), b AS (SELECT src, dst, type FROM e UNION ALL SELECT dst, src, type FROM e) SELECT n_nationkey, count(DISTINCT m.dst) AS parts FROM nation LEFT JOIN b s ON s.src = 'n' || n_nationkey AND s.type = 'IN' LEFT JOIN b m ON m.src = s.dst AND m.type = 'MADE_BY' GROUP BY 1")
def j10_two_hops(t: Tables) -> DataFrame:
    nodes = t.raw("nation").select("n_nationkey", F.concat(F.lit("n"), "n_nationkey").alias("node"))
    rows = graph.hop(graph.hop(nodes, _edges(t), "IN", "node", "supplier"), _edges(t), "MADE_BY", "supplier", "part")
    return rows.groupBy("n_nationkey").agg(F.count_distinct("part").alias("parts"))


@_query(f"""WITH {_TERMS}, m AS (SELECT term, p_partkey, p_brand FROM part JOIN terms ON term <> '' AND contains(lower(p_name), lower(term))),
    k AS (SELECT term, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands, count(*) AS drugs FROM m GROUP BY 1)
    SELECT term, coalesce(brands, '') AS brands, coalesce(drugs, 0) AS drugs FROM terms LEFT JOIN k USING (term)""")
def a11_details_of_terms(t: Tables) -> DataFrame:
    found = graph.containing(t.raw("part").select("p_brand", "p_name"), "p_name", _terms(t), "term")
    rows = found.groupBy("term").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("brands"), F.count("*").alias("drugs"))
    return _terms(t).join(rows, "term", "left").select("term", F.coalesce("brands", F.lit("")).alias("brands"), F.coalesce("drugs", F.lit(0)).alias("drugs"))


@_query("SELECT p_brand, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) = 1")
def w04_last_of_each(t: Tables) -> DataFrame:
    return graph.last_of_each(t.raw("part").select("p_brand", "p_partkey", "p_retailprice"), "p_brand", "p_partkey")


@_query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 100 OFFSET 100")
def o07_page(t: Tables) -> DataFrame:
    return graph.page(t.raw("part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], 100, 100)


# Builds and telemetry


@_query("SELECT o_orderkey FROM orders ANTI JOIN (SELECT l_orderkey AS o_orderkey FROM lineitem WHERE l_linestatus = 'F') l USING (o_orderkey)")
def j17_missing(t: Tables) -> DataFrame:
    done = t.raw("lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return telemetry.missing(t.raw("orders").select("o_orderkey"), done, ["o_orderkey"])


@_query("""WITH p AS (SELECT o_orderkey AS molecule_id, unnest(range(least(greatest(o_custkey % 9, 1), 7) * 2)) AS shard FROM orders),
    d AS (SELECT DISTINCT l_orderkey AS molecule_id, l_linenumber - 1 AS shard FROM lineitem),
    n AS (SELECT p.molecule_id, count(*) AS total FROM p GROUP BY 1), r AS (SELECT molecule_id, count(*) AS done FROM d GROUP BY 1)
    SELECT molecule_id, total, coalesce(done, 0) AS done, total - coalesce(done, 0) AS missing, total - coalesce(done, 0) BETWEEN 1 AND 3 AS nearly FROM n LEFT JOIN r USING (molecule_id)""")
def a23_shard_tail(t: Tables) -> DataFrame:
    molecules = t.raw("orders").select(F.col("o_orderkey").alias("molecule_id"), (F.col("o_custkey") % 9).alias("unit_count"))
    done = t.raw("lineitem").select(F.col("l_orderkey").alias("molecule_id"), (F.col("l_linenumber") - 1).alias("shard"))
    return telemetry.tail(telemetry.planned(molecules, "unit_count", 7, 2), done, 3)


@_query("""SELECT l_suppkey AS molecule_id, count(*) AS shards, CAST(sum(l_linenumber) AS BIGINT) AS emitted, round(sum(l_quantity), 2) AS worker_seconds,
    CASE WHEN sum(l_quantity) > 0 THEN round(sum(l_linenumber) / sum(l_quantity), 3) ELSE 0 END AS per_second FROM lineitem GROUP BY 1""")
def a15_shard_rollup(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").groupBy(F.col("l_suppkey").alias("molecule_id")).agg(
        F.count("*").alias("shards"), F.sum("l_linenumber").alias("emitted"), F.sum("l_quantity").alias("s")
    )
    return rows.select("molecule_id", "shards", "emitted", F.round("s", 2).alias("worker_seconds"), telemetry.rate(F.col("emitted"), F.col("s")).alias("per_second"))


@_query("SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS success, count(*) FILTER (WHERE o_orderstatus = 'O') AS skipped, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS failed, round(sum(o_totalprice), 0) AS fragment_rows FROM orders")
def a13_build_summary(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.raw("orders").agg(
        F.count("*").alias("total"), F.count_if(s == "F").alias("success"), F.count_if(s == "O").alias("skipped"),
        F.count_if(~s.isin("F", "O")).alias("failed"), F.round(F.sum("o_totalprice"), 0).alias("fragment_rows"),
    )


@_query("SELECT user_id, count(*) AS n, round(date_diff('microsecond', min(ts), max(ts)) / 3600000000.0, 3) AS hours FROM events GROUP BY 1")
def a17_durations(t: Tables) -> DataFrame:
    span = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 3_600_000_000
    return t.raw("events").groupBy("user_id").agg(F.count("*").alias("n"), F.round(span, 3).alias("hours"))


@_query("SELECT o_custkey, o_orderkey, row_number() OVER w AS chunk, sum(o_shippriority) OVER w AS so_far FROM (SELECT *, o_orderkey % 100 AS o_shippriority FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
def w08_running_chunks(t: Tables) -> DataFrame:
    rows = t.raw("orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 100).alias("rows"))
    return telemetry.running(rows, "o_custkey", "o_orderkey", "rows").drop("rows")


@_query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def d11_ledger_latest(t: Tables) -> DataFrame:
    return telemetry.latest(t.raw("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@_query("""SELECT string_agg(w || ':' || n, '; ' ORDER BY n DESC, w) AS labels FROM (
    SELECT w, count(*) AS n FROM (SELECT unnest(string_split(replace(p_type, ' ', ';'), ';')) AS w FROM part) WHERE w <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8)""")
def a20_label_frequencies(t: Tables) -> DataFrame:
    return telemetry.label_frequencies(t.raw("part").select(F.replace("p_type", F.lit(" "), F.lit(";")).alias("labels")), "labels", 8)


@_query("""SELECT coalesce(source, '(none)') AS source, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'fr') AS fr,
    string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0 END), 6) AS good FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def a19_rollup_by_source(t: Tables) -> DataFrame:
    rows = t.raw("documents").join(t.raw("labels"), "doc_id").groupBy(F.coalesce("source", F.lit("(none)")).alias("source"))
    return rows.agg(
        F.count_if(F.col("lang") == "en").alias("en"), F.count_if(F.col("lang") == "fr").alias("fr"),
        F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"), F.round(F.avg((F.col("quality") == 1).cast("double")), 6).alias("good"),
    )


@_query("SELECT * FROM (SELECT source, lang FROM documents) PIVOT (count(*) FOR lang IN ('de', 'en', 'es', 'fr') GROUP BY source)")
def a18_counts_by_kind(t: Tables) -> DataFrame:
    rows = t.raw("documents").groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).agg(F.count("doc_id"))
    return rows.na.fill(0)


@_query("SELECT p_partkey, round(0.23 * p_size + 0.13 * (p_size % 7) + 0.06 * (p_partkey % 5) + 0.04 * length(p_name) + 0.02 * length(p_type), 6) AS score FROM part")
def f22_complexity_score(t: Tables) -> DataFrame:
    size = F.col("p_size")
    value = telemetry.score(size, size % 7, F.col("p_partkey") % 5, F.length("p_name"), F.length("p_type"))
    return t.raw("part").select("p_partkey", F.round(value, 6).alias("score"))


# Audit


@_query("""SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'h' || user_id WHEN 1 THEN 'a' || user_id WHEN 2 THEN 'q ' || user_id WHEN 3 THEN 'u' || user_id
      WHEN 4 THEN CAST(user_id AS VARCHAR) WHEN 5 THEN 'f+' || user_id END AS user_id,
    CASE event_id % 8 WHEN 0 THEN 'header:x-user-id' WHEN 1 THEN 'header:x-authenticated-user-id' WHEN 2 THEN 'query:userId' WHEN 3 THEN 'path'
      WHEN 4 THEN 'json:userId' WHEN 5 THEN 'form:user_id' END AS user_id_source FROM events""")
def f16_identity(t: Tables) -> DataFrame:
    user, kind = F.col("user_id").cast("string"), F.col("event_id") % 8
    own = lambda prefix: F.concat(F.lit(prefix), user)
    media = F.when(kind.isin(4, 7), "application/json; charset=utf-8").when(kind == 5, "Application/X-WWW-Form-Urlencoded").otherwise("text/plain")
    headers = F.create_map(
        F.lit("Content-Type"), media, F.when(kind == 0, "X-User-Id").otherwise("x-userid"), F.concat(F.lit("  "), own("h")),
        F.when(kind == 1, "X-Authenticated-User-Id").otherwise("accept"), own("a"),
    )
    query = F.when(kind == 2, F.concat(F.lit("page=2&userId=old&userId=q%20"), user)).otherwise(F.lit("page=2&userid=9"))
    path = F.when(kind == 3, F.concat(F.lit("/api/users/u"), user, F.lit("/x"))).otherwise(F.lit("/api/items"))
    body = (
        F.when(kind == 4, F.concat(F.lit('{"user_id": [1], "userId": '), user, F.lit("}")))
        .when(kind == 5, F.concat(F.lit("x=1&user_id=&user_id=f%2B"), user))
        .when(kind == 7, F.lit('{"user_id": {"a": 1}, "userId": 1.5}'))
        .otherwise(F.concat(F.lit('{"user_id": "b'), user, F.lit('"}')))
    )
    return t.raw("events").select("event_id", audit.identity(headers, query, path, body).alias("found")).select("event_id", "found.user_id", "found.user_id_source")


@_query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"PASSWORD":"***","event":"' || event_type || '"}'
    WHEN 1 THEN '{"a":[{"token":"***","max_tokens":' || user_id || '}]}'
    WHEN 2 THEN '{"Secret":"***","b":{"api_key":"***","c":null}}' ELSE 'password=' || user_id END AS record FROM events""")
def f13_masked(t: Tables) -> DataFrame:
    user, kind = F.col("user_id").cast("string"), F.col("event_id") % 4
    record = (
        F.when(kind == 0, F.concat(F.lit('{"PASSWORD": "'), user, F.lit('", "event": "'), F.col("event_type"), F.lit('"}')))
        .when(kind == 1, F.concat(F.lit('{"a": [{"token": {"a": "'), user, F.lit('"}, "max_tokens": '), user, F.lit("}]}")))
        .when(kind == 2, F.concat(F.lit('{"Secret": ["'), user, F.lit('", 1], "b": {"api_key": 7.5, "c": null}}')))
        .otherwise(F.concat(F.lit("password="), user))
    )
    return t.raw("events").select("event_id", audit.masked(record).alias("record"))


@_query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN NULL ELSE (['i', 'c', 's', 'n'])[p_partkey % 5 + 1] || p_partkey END AS smiles FROM part")
def f15_compound_smiles(t: Tables) -> DataFrame:
    place = (F.col("p_partkey") % 5).cast("int")
    names = ["ConnectivitySMILES", "SMILES", "CanonicalSMILES", "IsomericSMILES"]
    value = lambda letter, at: F.when(place <= at, F.concat(F.lit(letter), F.col("p_partkey").cast("string"))).otherwise(F.lit(""))
    fields = F.struct(*[value(x, at).alias(n) for n, x, at in zip(names, "nsci", (3, 2, 1, 0))])
    record = F.to_json(F.struct(F.struct(F.array(fields).alias("Properties")).alias("PropertyTable")))
    return t.raw("part").select("p_partkey", readers.compound_smiles(record).alias("smiles"))


@_query("SELECT strftime(time_bucket(INTERVAL 1 day, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def t08_requests_by_day(t: Tables) -> DataFrame:
    rows = audit.requests_by(t.raw("events"), "ts", "event_type", "1 day")
    return rows.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@_query("SELECT strftime(time_bucket(INTERVAL 1 day, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def t08_streamed_requests_by_day(t: Tables) -> DataFrame:
    return ingest.streamed_requests(t)


@_query("SELECT page_id, url, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, CASE WHEN length(url) > 20 THEN left(url, 20) || '…' ELSE url END AS short FROM pages")
def f12_urls(t: Tables) -> DataFrame:
    host = F.regexp_extract("url", "^https?://([^/:?#]+)", 1)
    return t.raw("pages").select("page_id", "url", host.alias("host"), audit.truncated(F.col("url"), 20, "…").alias("short"))


# Fragments of graphs


_UNITS = """u AS (SELECT molecule_id, (row_number() OVER (PARTITION BY molecule_id ORDER BY a, b) - 1) AS n, a, b, b <= 3 AS ring FROM bonds),
    g AS (SELECT molecule_id, ring AND count(*) FILTER (WHERE ring) OVER (PARTITION BY molecule_id) = 3 AS sys, n, a, b FROM u),
    o AS (SELECT molecule_id, CASE WHEN sys THEN 0 ELSE n END AS unit, bool_or(sys) AS sys, list_sort(list_distinct(list(a) || list(b))) AS own FROM g GROUP BY 1, 2),
    w AS (SELECT x.molecule_id, x.unit, list_sort(list_distinct([x.unit, coalesce(s.unit, x.unit)])) AS has, list_sort(list_distinct(x.own || coalesce(s.own, x.own))) AS own
          FROM o x LEFT JOIN o s ON s.molecule_id = x.molecule_id AND s.sys AND list_has_any(x.own, s.own)),
    f AS (SELECT molecule_id, has AS units, own AS atoms FROM w
          UNION SELECT f.molecule_id, list_sort(list_distinct(units || has)), list_sort(list_distinct(atoms || own)) FROM f JOIN w ON f.molecule_id = w.molecule_id
          WHERE NOT list_contains(units, unit) AND list_has_any(atoms, own) AND len(list_distinct(atoms || own)) <= 5)
    SELECT molecule_id, array_to_string(units, ',') AS units, array_to_string(atoms, ',') AS atoms FROM f WHERE len(atoms) <= 5"""


@_query(_UNITS, "bonds", recursive=True)
def c12_connected_fragments(t: Tables) -> DataFrame:
    bonds = fragments.with_bond_numbers(t.bonds())
    ring = F.col("b") <= 3
    whole = F.count_if(ring).over(Window.partitionBy("molecule_id")) == 3
    units = fragments.super_units(bonds.withColumn("system", F.when(ring & whole, F.lit(0))))
    each = units.select("molecule_id", "unit", F.explode(F.array("a", "b")).alias("atom")).distinct()
    systems = units.where("system is not null").select("molecule_id", "unit").distinct()
    found = fragments.enumerated(each, 5, systems)
    return found.select("molecule_id", F.array_join("units", ",").alias("units"), F.array_join("atoms", ",").alias("atoms"))


_WAYS = "w AS (SELECT molecule_id, a, b FROM bonds UNION SELECT molecule_id, b, a FROM bonds)"


@_query(
    f"""{_WAYS}, p AS (SELECT x.molecule_id, x.atom AS i, y.atom AS j, z.atom AS k FROM atoms x
      JOIN w v ON v.molecule_id = x.molecule_id AND v.a = x.atom JOIN atoms y ON y.molecule_id = x.molecule_id AND y.atom = v.b
      JOIN w u ON u.molecule_id = x.molecule_id AND u.a = y.atom JOIN atoms z ON z.molecule_id = x.molecule_id AND z.atom = u.b
      WHERE x.label = 'A' AND y.label = 'R' AND z.label = 'A' AND z.atom <> x.atom),
    q AS (SELECT x.molecule_id, x.atom AS i, y.atom AS j FROM atoms x JOIN w v ON v.molecule_id = x.molecule_id AND v.a = x.atom
      JOIN atoms y ON y.molecule_id = x.molecule_id AND y.atom = v.b WHERE x.label = 'A' AND y.label = 'N')
    SELECT DISTINCT p.molecule_id FROM p JOIN q ON p.molecule_id = q.molecule_id AND q.i NOT IN (p.i, p.j, p.k) AND q.j NOT IN (p.i, p.j, p.k)""",
    "bonds", "atoms",
)
def c30_disjoint_substructures(t: Tables) -> DataFrame:
    patterns = [matching.Pattern(("A", "R", "A"), ((0, 1), (1, 2))), matching.Pattern(("A", "N"), ((0, 1),))]
    return matching.disjoint(patterns, t.atoms(), t.bonds())


@_query(
    """w AS (SELECT molecule_id, a, b FROM bonds UNION SELECT molecule_id, b, a FROM bonds),
    l AS (SELECT x.molecule_id, x.atom, sha256(x.label || '|' || coalesce(string_agg(y.label, ',' ORDER BY y.label), '')) AS label
      FROM atoms x LEFT JOIN w ON w.molecule_id = x.molecule_id AND w.a = x.atom LEFT JOIN atoms y ON y.molecule_id = x.molecule_id AND y.atom = w.b
      GROUP BY x.molecule_id, x.atom, x.label)
    SELECT molecule_id, sha256(string_agg(label, ',' ORDER BY label)) AS signature FROM l GROUP BY 1""",
    "bonds", "atoms",
)
def c02_molecule_signatures(t: Tables) -> DataFrame:
    whole = t.atoms().groupBy("molecule_id").agg(F.array_sort(F.collect_list("atom")).alias("atoms")).withColumn("units", F.array(F.lit(0)))
    return matching.signatures(whole, t.atoms(), t.bonds(), 1).select("molecule_id", "signature")


@_query("""SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus AS kind FROM (SELECT * FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC, l_tax DESC, l_partkey DESC, l_linestatus) = 1)
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_quantity DESC, l_tax DESC, l_partkey DESC, l_linestatus, l_linenumber) = 1""")
def w01_best_candidates(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").alias("priority"), F.col("l_tax").alias("is_protected"),
        F.col("l_partkey").alias("heavy_atoms"), F.col("l_linestatus").alias("kind"),
    )
    best = fragments.best_of(rows, "l_orderkey", "l_linenumber", "l_returnflag")
    return best.select("l_orderkey", "l_linenumber", "l_returnflag", "kind")


@_query("SELECT p_partkey, sha256(p_name) AS sha256, sha1(p_name) AS sha1, trim(lower(p_name)) AS low, list_aggregate(list_filter(list_transform(string_split(p_type, ' '), lambda x: trim(x)), lambda x: x <> ''), 'string_agg', ';') AS parts FROM part")
def f18_hashes_and_splits(t: Tables) -> DataFrame:
    return t.raw("part").select(
        "p_partkey", F.sha2("p_name", 256).alias("sha256"), F.sha1("p_name").alias("sha1"), F.trim(F.lower("p_name")).alias("low"),
        F.array_join(scalars.split_trimmed(F.col("p_type"), " "), ";").alias("parts"),
    )


# More of the same tables


@_query("SELECT CAST(batch AS INT) AS batch, count(DISTINCT molecule_id) AS molecules, count(*) AS fragment_rows FROM fragments GROUP BY 1", "fragments")
def a16_totals_by_batch(t: Tables) -> DataFrame:
    return t.fragments().groupBy("batch").agg(F.count_distinct("molecule_id").alias("molecules"), F.count("*").alias("fragment_rows"))


@_query("SELECT p_brand, count(*) AS fragments, count(*) FILTER (WHERE p_type LIKE '%STEEL%') AS with_ring, round(100.0 * count(*) FILTER (WHERE p_type LIKE '%STEEL%') / count(*), 4) AS ring_pct FROM part GROUP BY 1")
def a22_shares_by_brand(t: Tables) -> DataFrame:
    ring = F.contains("p_type", F.lit("STEEL"))
    rows = t.raw("part").groupBy("p_brand").agg(F.count("*").alias("fragments"), F.count_if(ring).alias("with_ring"))
    return rows.withColumn("ring_pct", F.round(100.0 * F.col("with_ring") / F.col("fragments"), 4))


@_query("SELECT count(*) AS total, count(TRY_CAST(regexp_extract(url, '(\\d+)', 1) AS INT)) AS success, count(*) - count(TRY_CAST(regexp_extract(url, '(\\d+)', 1) AS INT)) AS fail FROM pages")
def a24_success_and_failure(t: Tables) -> DataFrame:
    number = F.expr(r"try_cast(regexp_extract(url, '(\\d+)', 1) AS INT)")
    return t.raw("pages").agg(F.count("*").alias("total"), F.count_if(number.isNotNull()).alias("success"), F.count_if(number.isNull()).alias("fail"))


@_query("SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS place FROM part")
def o11_ranking(t: Tables) -> DataFrame:
    rows = t.raw("part").select("p_brand", "p_partkey", F.col("p_size").alias("score"))
    return ranking.numbered_within(rows, ["p_brand"], [-F.col("score"), "p_partkey"], "place").drop("score")


@_query("SELECT l_suppkey, l_partkey, min((l_orderkey, l_linenumber))[1] AS l_orderkey, min((l_orderkey, l_linenumber))[2] AS l_linenumber FROM lineitem GROUP BY 1, 2")
def w02_witnesses(t: Tables) -> DataFrame:
    return fragments.witnesses(t.raw("lineitem"), ["l_suppkey", "l_partkey"], ["l_orderkey", "l_linenumber"])


@_query("SELECT p_partkey, unnest(range(len(string_split(p_type, ' ')))) + 1 AS number, unnest(string_split(p_type, ' ')) AS word FROM part")
def w06_numbered_children(t: Tables) -> DataFrame:
    words = F.transform(F.split("p_type", " "), lambda w: F.struct(w.alias("word")))
    return dialogue.exploded(t.raw("part").select("p_partkey", words.alias("words")), "p_partkey", "words")


@_query("SELECT x.p_partkey AS a, y.p_partkey AS b, list_has_any(string_split(x.p_type, ' '), string_split(y.p_type, ' ')) AS overlap, len(list_intersect(string_split(x.p_type, ' '), string_split(y.p_type, ' '))) AS common FROM part x JOIN part y ON y.p_partkey = x.p_partkey + 1")
def u05_array_sets(t: Tables) -> DataFrame:
    rows = t.raw("part").select(F.col("p_partkey").alias("a"), F.split("p_type", " ").alias("x"))
    after = rows.select((F.col("a") - 1).alias("a"), F.col("a").alias("b"), F.col("x").alias("y"))
    return rows.join(after, "a").select("a", "b", F.arrays_overlap("x", "y").alias("overlap"), F.size(F.array_intersect("x", "y")).cast("long").alias("common"))


@_query("SELECT doc_id, strlen(text) - length(text) AS more FROM documents WHERE strlen(text) <> length(text)")
def u04_lengths_that_differ(t: Tables) -> DataFrame:
    more = F.octet_length("text").cast("long") - F.char_length("text")
    return t.raw("documents").where(F.octet_length("text") != F.char_length("text")).select("doc_id", more.alias("more"))


@_query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_suppkey = o.o_custkey % 100)")
def j16_not_in_ledger(t: Tables) -> DataFrame:
    listing = t.raw("orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 100).alias("place"))
    ledger = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("place"))
    return telemetry.missing(listing, ledger, ["o_orderkey", "place"]).drop("place")


@_query("WITH c AS (SELECT upper(n_name) AS k, min(n_nationkey) AS smiles FROM nation WHERE n_nationkey % 2 = 0 GROUP BY 1) SELECT s_suppkey, CAST(c.smiles AS VARCHAR) AS smiles FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN c ON upper(lower(n_name)) = c.k")
def j18_lookup_in_any_case(t: Tables) -> DataFrame:
    cache = t.raw("nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("smiles"))
    names = t.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.lower("n_name").alias("ingredient"))
    return readers.looked_up(t.raw("supplier").join(names, "s_nationkey").select("s_suppkey", "ingredient"), "ingredient", cache).select("s_suppkey", "smiles")


@_query("SELECT DISTINCT o.dialogue_id, p.p_partkey FROM (SELECT * FROM dialogues WHERE title = '1-URGENT') o JOIN turns t USING (dialogue_id) JOIN part p ON p.p_partkey = t.part AND p.p_size >= 40", "dialogues", "turns")
def j19_rules_by_key(t: Tables) -> DataFrame:
    rules = t.raw("part").where("p_size >= 40").select(F.col("p_partkey").alias("part"))
    rows = t.dialogues().where("title = '1-URGENT'").join(t.turns(), "dialogue_id").join(rules, "part")
    return rows.select("dialogue_id", F.col("part").alias("p_partkey")).distinct()


@_query("WITH l AS (SELECT l_orderkey, count(*) AS shards FROM lineitem GROUP BY 1) SELECT o_orderkey, c_mktsegment AS segment, coalesce(shards, 0) AS shards FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 LEFT JOIN l ON l_orderkey = o_orderkey")
def j21_features_and_status(t: Tables) -> DataFrame:
    features = t.raw("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    status = t.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("shards"))
    rows = t.raw("orders").join(features, "o_custkey", "left").join(status, "o_orderkey", "left")
    return rows.select("o_orderkey", "segment", F.coalesce("shards", F.lit(0)).alias("shards"))


@_query(
    """p AS (SELECT molecule_id, list_sort([a, b]) AS atoms FROM bonds),
    r AS (SELECT molecule_id, list_sort(list(atom)) AS atoms FROM atoms WHERE label = 'N' GROUP BY 1)
    SELECT molecule_id, array_to_string(atoms, ',') AS atoms FROM p WHERE NOT EXISTS (
      SELECT 1 FROM r WHERE r.molecule_id = p.molecule_id AND list_has_all(r.atoms, p.atoms) AND len(p.atoms) < len(r.atoms))""",
    "bonds", "atoms",
)
def p19_not_within_residues(t: Tables) -> DataFrame:
    parts = t.bonds().select("molecule_id", F.array("a", "b").alias("atoms"))
    residues = t.atoms().where("label = 'N'").groupBy("molecule_id").agg(F.collect_list("atom").alias("atoms"))
    return fragments.not_within(parts, residues, "molecule_id").select("molecule_id", F.array_join("atoms", ",").alias("atoms"))


@_query(
    """w AS (SELECT molecule_id, a, b FROM bonds UNION SELECT molecule_id, b, a FROM bonds),
    f AS (SELECT DISTINCT molecule_id, [a] AS atoms FROM w
          UNION SELECT f.molecule_id, list_sort(list_append(atoms, b)) FROM f JOIN w ON f.molecule_id = w.molecule_id
          AND list_contains(atoms, a) AND NOT list_contains(atoms, b) WHERE len(atoms) < 4)
    SELECT molecule_id, array_to_string(atoms, ',') AS atoms FROM f WHERE len(atoms) >= 3""",
    "bonds", recursive=True,
)
def c16_connected_atoms(t: Tables) -> DataFrame:
    return fragments.connected_atoms(t.bonds(), 3, 4).select("molecule_id", F.array_join("atoms", ",").alias("atoms"))


@_query(
    """e AS (SELECT molecule_id, a AS atom FROM bonds UNION ALL SELECT molecule_id, b FROM bonds), d AS (SELECT molecule_id, atom, count(*) AS n FROM e GROUP BY 1, 2),
    g AS (SELECT molecule_id, CAST(sum(n) / 2 AS BIGINT) AS bonds, CAST(sum(greatest(n - 2, 0)) AS BIGINT) AS branches FROM d GROUP BY 1),
    s AS (SELECT molecule_id, count(*) AS heavy_atoms, count(*) FILTER (WHERE label NOT IN ('A', 'C')) AS hetero_atoms FROM atoms GROUP BY 1),
    -- Of bonded atoms all but the least of each part end a bond, so the rest are the parts.
    p AS (SELECT molecule_id, count(DISTINCT b) AS ends FROM bonds GROUP BY 1)
    SELECT molecule_id, heavy_atoms, coalesce(bonds, 0) AS bonds, coalesce(bonds - ends, 0) AS rings, coalesce(branches, 0) AS branches, hetero_atoms FROM s LEFT JOIN g USING (molecule_id) LEFT JOIN p USING (molecule_id)""",
    "bonds", "atoms",
)
def c31_structural_features(t: Tables) -> DataFrame:
    return fragments.shapes(t.bonds(), t.atoms(), ("A", "C"))


@_query("SELECT dialogue_id, CASE WHEN user_id % 10 = 0 THEN 'renamed' ELSE title END AS title, is_deleted OR user_id % 25 = 0 AS is_deleted FROM dialogues", "dialogues")
def d05_updates_and_soft_deletes(t: Tables) -> DataFrame:
    rows = dialogue.updated(t.dialogues(), F.col("user_id") % 10 == 0, title=F.lit("renamed"))
    return dialogue.updated(rows, F.col("user_id") % 25 == 0, is_deleted=F.lit(True)).select("dialogue_id", "title", "is_deleted")


@_query("SELECT l_orderkey, l_suppkey, min(l_linenumber) AS l_linenumber FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2")
def d06_refused_duplicates(t: Tables) -> DataFrame:
    new = t.raw("lineitem").where("l_returnflag = 'N'").select("l_orderkey", "l_suppkey", "l_linenumber")
    return dialogue.appended(new.limit(0), new, ["l_orderkey", "l_suppkey"])[0]


@_query("SELECT n_name, round(sum(s_acctbal), 2) AS balance, CAST(NULL AS VARCHAR) AS note FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 UNION ALL SELECT r_name, 0, 'region' FROM region")
def d10_added_columns(t: Tables) -> DataFrame:
    nations = t.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    old = t.raw("supplier").join(nations, "s_nationkey").groupBy("n_name").agg(F.round(F.sum("s_acctbal"), 2).alias("balance"))
    new = t.raw("region").select(F.col("r_name").alias("n_name"), F.lit(0.0).alias("balance"), F.lit("region").alias("note"))
    return old.unionByName(new, allowMissingColumns=True)


_KINDS = ["module", "linker", "functional_group", "amino_acid_residue", "other"]
_CLASSES = ["fused_ring", "ring_system", "rigid_linker", "amide", "small_group", "amine", "flexible_linker"]


@_query(
    """WITH k AS (SELECT p_partkey, (['module', 'linker', 'functional_group', 'amino_acid_residue', 'other'])[p_partkey % 5 + 1] AS kind,
      (['fused_ring', 'ring_system', 'rigid_linker', 'amide', 'small_group', 'amine', 'flexible_linker'])[p_size % 7 + 1] AS label,
      p_size * 2 AS high, p_size % 9 AS heavy, p_partkey % 3 AS rings, p_partkey % 4 AS rotatable, p_partkey % 11 = 0 AS side FROM part)
    SELECT p_partkey, CASE WHEN kind = 'amino_acid_residue' THEN 'complete_amino_acid_residue' WHEN side THEN 'recognized_amino_acid_side_chain'
      WHEN kind = 'module' AND label = 'fused_ring' THEN 'privileged_or_fused_module'
      WHEN kind = 'module' AND label = 'ring_system' AND heavy >= 5 AND rings >= 1 AND high >= 85 THEN 'high_semantic_module'
      WHEN kind = 'module' AND NOT heavy <= 4 AND NOT (heavy <= 5 AND rings <= 1 AND label IN ('amine', 'ring_system', 'amide')) AND high >= 88 THEN 'high_semantic_module'
      WHEN kind = 'module' THEN 'small_common_module_without_distinctive_semantic_density'
      WHEN kind = 'linker' AND (label = 'rigid_linker' AND heavy >= 4 OR label = 'flexible_linker' AND heavy >= 5 AND rotatable >= 2) THEN 'distinctive_linker_unit'
      WHEN kind = 'linker' THEN 'short_low_information_linker'
      WHEN kind = 'functional_group' AND label = 'amide' THEN 'high_semantic_functional_group'
      WHEN kind = 'functional_group' AND high >= 45 AND heavy >= 4 THEN 'medium_complex_functional_group'
      WHEN kind = 'functional_group' AND (label = 'small_group' OR heavy <= 2) THEN 'small_low_information_group'
      WHEN kind = 'functional_group' THEN 'default_functional_group'
      WHEN high >= 90 AND (rings >= 1 OR heavy >= 6) THEN 'fallback_high_priority_semantic_unit' ELSE 'default_fallback_non_terminal_unit' END AS reason FROM k"""
)
def c27_stop_rules(t: Tables) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    rows = t.raw("part").select(
        "p_partkey",
        F.get(F.array(*map(F.lit, _KINDS)), (key % 5).cast("int")).alias("semantic_type"),
        F.array(F.get(F.array(*map(F.lit, _CLASSES)), size % 7)).alias("semantic_class"),
        (size * 2).alias("priority"), (size % 9).alias("heavy_atoms"), (key % 3).alias("ring_count"), F.lit(0).alias("aromatic_ring_count"),
        (key % 4).alias("rotatable_bonds"), F.lit(False).alias("is_complete_residue"), (key % 11 == 0).alias("is_side_chain"),
    )
    return rows.select("p_partkey", semantics.stop()["reason"].alias("reason"))


# Details of drugs, paths and rings, and the rest of the reports


@_query("""WITH w AS (SELECT p_brand, p_partkey, unnest(range(len(string_split(p_name, ' ')))) AS pos, unnest(string_split(p_name, ' ')) AS word FROM part),
    f AS (SELECT p_brand, word, min((p_partkey, pos)) AS place FROM w GROUP BY 1, 2)
    SELECT p_brand, string_agg(word, ',' ORDER BY place) AS words FROM f GROUP BY 1""")
def a11_ordered_union(t: Tables) -> DataFrame:
    rows = graph.ordered_union(t.raw("part").select("p_brand", "p_partkey", F.split("p_name", " ").alias("words")), "p_brand", "p_partkey", "words", "words")
    return rows.select("p_brand", F.array_join("words", ",").alias("words"))


@_query("SELECT p_partkey, array_to_string(list_filter(list_transform(w, lambda x, i: CASE WHEN list_position(w, x) = i THEN x END), lambda x: x IS NOT NULL), ' ') AS words FROM (SELECT p_partkey, string_split(p_type || ' ' || p_name || ' ' || p_type, ' ') AS w FROM part)")
def a12_words_once(t: Tables) -> DataFrame:
    words = F.split(F.concat_ws(" ", "p_type", "p_name", "p_type"), " ")
    return t.raw("part").select("p_partkey", F.array_join(F.array_distinct(words), " ").alias("words"))


@_query("""WITH d AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'F'),
    f AS (SELECT *, l_returnflag = 'R' AS tmp FROM lineitem)
    SELECT (SELECT count(*) FROM orders) AS expected_molecule_count, (SELECT count(*) FROM orders JOIN d ON o_orderkey = l_orderkey) AS success_molecule_count,
      (SELECT count(*) FROM orders ANTI JOIN d ON o_orderkey = l_orderkey) AS missing_success_count, count(*) FILTER (WHERE tmp) AS tmp_file_count,
      count(*) FILTER (WHERE NOT tmp AND l_suppkey % 7 = 0) AS bad_checksum_count, count(*) FILTER (WHERE NOT tmp) AS total_parquet_files,
      CAST(sum(CASE WHEN NOT tmp THEN l_partkey ELSE 0 END) AS BIGINT) AS total_parquet_size_bytes, false AS ok FROM f""")
def a14_build_validation(t: Tables) -> DataFrame:
    lines = t.raw("lineitem")
    name = F.concat(F.lit("chunk_"), F.col("l_linenumber").cast("string"), F.when(F.col("l_returnflag") == "R", ".parquet.tmp").otherwise(".parquet"))
    files = lines.select(name.alias("name"), F.col("l_partkey").alias("bytes"), (F.col("l_suppkey") % 7 != 0).alias("intact"))
    markers = lines.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("molecule_id"))
    return telemetry.validation(t.raw("orders").select(F.col("o_orderkey").alias("molecule_id")), markers, files)


@_query("SELECT count(*) FILTER (WHERE p_size % 3 = 0) AS missing_smiles, CAST(sum(len(string_split(p_name, ' '))) AS BIGINT) AS expanded_rows FROM part")
def a25_missing_and_expanded(t: Tables) -> DataFrame:
    smiles = F.when(F.col("p_size") % 3 != 0, F.col("p_type"))
    return t.raw("part").agg(F.count_if(smiles.isNull()).alias("missing_smiles"), F.sum(F.size(F.split("p_name", " "))).alias("expanded_rows"))


@_query("SELECT conv_id, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS svg_count FROM conversations GROUP BY 1")
def a26_summed_sizes(t: Tables) -> DataFrame:
    turns = t.raw("conversations").groupBy("conv_id").agg(F.collect_list(F.size(F.split("text", " "))).alias("sizes"))
    return turns.select("conv_id", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda n, x: n + x).alias("svg_count"))


@_query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def w03_first_seen(t: Tables) -> DataFrame:
    return ranking.first(t.raw("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@_query("SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_type, p_partkey) AS place FROM part")
def o05_largest_first(t: Tables) -> DataFrame:
    rows = t.raw("part").select("p_partkey", "p_type", (-F.col("p_size")).alias("size"))
    return ranking.numbered(rows, ["size", "p_type", "p_partkey"], "place").select("p_partkey", "place")


@_query("SELECT p_partkey, row_number() OVER (ORDER BY n, length(p_name) DESC, p_partkey) AS place FROM (SELECT p_partkey, p_name, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS n FROM part)")
def o13_rare_and_large_first(t: Tables) -> DataFrame:
    counts = t.raw("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    rows = t.raw("part").join(counts, "p_partkey", "left").select("p_partkey", F.coalesce("n", F.lit(0)).alias("n"), (-F.length("p_name")).alias("size"))
    return ranking.numbered(rows, ["n", "size", "p_partkey"], "place").select("p_partkey", "place")


@_query("SELECT DISTINCT molecule_id FROM atoms WHERE label <> 'A'", "atoms")
def p16_not_all_carbon(t: Tables) -> DataFrame:
    return fragments.not_all_carbon(t.atoms(), ("A",))


@_query(
    """w AS (SELECT molecule_id, a, b FROM bonds UNION SELECT molecule_id, b, a FROM bonds),
    p AS (SELECT DISTINCT molecule_id, [a] AS path FROM w UNION ALL
          SELECT p.molecule_id, list_append(path, b) FROM p JOIN w ON p.molecule_id = w.molecule_id AND path[-1] = a AND NOT list_contains(path, b) WHERE len(path) < 5)
    SELECT DISTINCT molecule_id, array_to_string(list_sort(path), ',') AS path FROM p WHERE len(path) >= 3""",
    "bonds", recursive=True,
)
def c22_simple_paths(t: Tables) -> DataFrame:
    return fragments.atom_paths(t.bonds(), 3, 5).select("molecule_id", F.array_join("path", ",").alias("path"))


@_query("SELECT x.molecule_id, '1,2,3' AS atoms FROM bonds x JOIN bonds y ON y.molecule_id = x.molecule_id AND y.a = 2 AND y.b = 3 JOIN bonds z ON z.molecule_id = x.molecule_id AND z.a = 1 AND z.b = 3 WHERE x.a = 1 AND x.b = 2", "bonds")
def c21_ring_fragments(t: Tables) -> DataFrame:
    return fragments.ring_fragments(t.bonds()).select("molecule_id", F.array_join("atoms", ",").alias("atoms"))


_BRANDS = "m AS (SELECT DISTINCT p_brand FROM part UNION SELECT 'none-' || n_name FROM nation)"


@_query(f"""WITH {_BRANDS}, l AS (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) = 1),
    e AS (SELECT l_partkey, string_agg(DISTINCT l_suppkey, ',' ORDER BY l_suppkey) AS enzymes FROM lineitem GROUP BY 1)
    SELECT p_brand, l.p_partkey IS NOT NULL AS drug_found, l.p_type AS type, CAST(l.p_size AS VARCHAR) AS size, CASE WHEN l.p_partkey IS NULL THEN 0 ELSE 2 END AS fields,
      coalesce(enzymes, '') AS enzymes FROM m LEFT JOIN l USING (p_brand) LEFT JOIN e ON e.l_partkey = l.p_partkey""")
def e02_details_by_drug(t: Tables) -> DataFrame:
    part = t.raw("part")
    names = part.select("p_brand").union(t.raw("nation").select(F.concat(F.lit("none-"), "n_name"))).distinct()
    near = t.raw("lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    rows = graph.details(names, part, near, "p_brand", "p_partkey", ["p_type", "p_size"], "l_suppkey", "enzymes")
    return rows.select("p_brand", "drug_found", F.col("data")["p_type"].alias("type"), F.col("data")["p_size"].alias("size"), F.size("data").alias("fields"), F.array_join("enzymes", ",").alias("enzymes"))


@_query(
    """w AS (SELECT molecule_id, a, b FROM bonds UNION SELECT molecule_id, b, a FROM bonds),
    f AS (SELECT DISTINCT x.molecule_id FROM atoms x JOIN w ON w.molecule_id = x.molecule_id AND w.a = x.atom JOIN atoms y ON y.molecule_id = x.molecule_id AND y.atom = w.b WHERE x.label = 'A' AND y.label = 'R')
    SELECT o_orderkey AS molecule_id, o_orderpriority AS ingredient, c_name AS owner FROM orders JOIN f ON o_orderkey = molecule_id LEFT JOIN customer ON c_custkey = o_custkey""",
    "bonds", "atoms",
)
def e01_fragment_search(t: Tables) -> DataFrame:
    found = matching.disjoint([matching.Pattern(("A", "R"), ((0, 1),))], t.atoms(), t.bonds())
    owners = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("owner"))
    rows = t.raw("orders").select(F.col("o_orderkey").alias("molecule_id"), "o_custkey", F.col("o_orderpriority").alias("ingredient"))
    return rows.join(found, "molecule_id").join(owners, "o_custkey", "left").select("molecule_id", "ingredient", "owner")


@_query("SELECT doc_id, status, comment FROM reviews ANTI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) l USING (doc_id)", "reviews")
def d07_deleted_reviews(t: Tables) -> DataFrame:
    return dialogue.removed(t.reviews(), t.raw("labels").where("toxic = 1"), ["doc_id"]).select("doc_id", "status", "comment")


@_query("""SELECT p_partkey, len(string_split(p_type, ' ')) AS turn_count, 'types' AS kind, unnest(range(len(string_split(p_type, ' ')))) + 1 AS number, unnest(string_split(p_type, ' ')) AS word FROM part
    UNION ALL SELECT p_partkey, len(string_split(p_type, ' ')), 'names', unnest(range(len(string_split(p_name, ' ')))) + 1, unnest(string_split(p_name, ' ')) FROM part""")
def d04_nested_records(t: Tables) -> DataFrame:
    listed = lambda c: F.transform(F.split(c, " "), lambda w: F.struct(w.alias("word")))
    return dialogue.unnested(t.raw("part").select("p_partkey", listed("p_type").alias("types"), listed("p_name").alias("names")), "p_partkey", ["types", "names"], "word")


@_query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'unfinished' END AS half,
    row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""")
def o11_halves(t: Tables) -> DataFrame:
    rows = t.raw("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "finished").otherwise("unfinished").alias("half"), (-F.col("o_totalprice")).alias("order"))
    halves = [ranking.numbered(rows.where(F.col("half") == h), ["order", "o_orderkey"], "place") for h in ("finished", "unfinished")]
    return halves[0].unionByName(halves[1]).select("o_orderkey", "half", "place")


@_query("SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_suppkey % 3 = 0) l ON l_orderkey = o_orderkey AND o_orderstatus = 'F'")
def j11_hop_and_filter(t: Tables) -> DataFrame:
    edges = t.raw("lineitem").where("l_suppkey % 3 = 0").select(F.concat(F.lit("o"), "l_orderkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.lit("HAS").alias("type")).distinct()
    nodes = t.raw("orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.concat(F.lit("o"), "o_orderkey").alias("node"))
    return graph.hop(nodes, edges, "HAS", "node", "maker").where("maker is not null").drop("node", "maker").distinct()


@_query("SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS name, coalesce(nullif(p_size % 4, 0), -1) AS size, regexp_extract('x/molecule_id=' || p_partkey || '/y', 'molecule_id=([^/]+)', 1) AS molecule, CASE WHEN p_partkey % 2 = 0 THEN '13800000000' ELSE '23800000000' END SIMILAR TO '1[3-9][0-9]{9}' AS phone, '`a``' || p_partkey || '`' AS quoted FROM part")
def f07_scalars(t: Tables) -> DataFrame:
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)"))
    size = F.coalesce(scalars.zero_as_null(F.col("p_size") % 4), F.lit(-1))
    molecule = scalars.path_molecule(F.concat(F.lit("x/molecule_id="), F.col("p_partkey").cast("string"), F.lit("/y")))
    phone = scalars.is_phone(F.when(F.col("p_partkey") % 2 == 0, "13800000000").otherwise("23800000000"))
    quoted = F.concat(F.lit(scalars.quoted("a`")[:-1]), F.col("p_partkey").cast("string"), F.lit("`"))
    return t.raw("part").select("p_partkey", name.alias("name"), size.alias("size"), molecule.alias("molecule"), phone.alias("phone"), quoted.alias("quoted"))


# Parts, paths and rules of molecules; nodes and requests; what is written and read again


_TWO_WAYS = "w AS (SELECT molecule_id, a, b FROM bonds UNION SELECT molecule_id, b, a FROM bonds)"


@_query(
    f"""{_TWO_WAYS}, l AS (SELECT molecule_id, atom FROM atoms WHERE label <> 'R'),
    r AS (SELECT molecule_id, atom, atom AS near FROM l
          UNION SELECT r.molecule_id, r.atom, w.b FROM r JOIN w ON w.molecule_id = r.molecule_id AND w.a = r.near JOIN l ON l.molecule_id = w.molecule_id AND l.atom = w.b),
    p AS (SELECT molecule_id, atom, min(near) AS part FROM r GROUP BY 1, 2)
    SELECT molecule_id, string_agg(atom, ',' ORDER BY atom) AS atoms FROM p GROUP BY molecule_id, part""",
    "bonds", "atoms", recursive=True,
)
def c26_uncovered_parts(t: Tables) -> DataFrame:
    found = fragments.uncovered_parts(t.atoms(), t.bonds(), t.atoms().where("label = 'R'"))
    return found.select("molecule_id", F.array_join("atoms", ",").alias("atoms"))


@_query(
    f"""{_TWO_WAYS}, p AS (SELECT DISTINCT molecule_id, [a] AS path FROM w UNION ALL
          SELECT p.molecule_id, list_append(path, b) FROM p JOIN w ON p.molecule_id = w.molecule_id AND path[-1] = a AND NOT list_contains(path, b) WHERE len(path) < 4),
    q AS (SELECT DISTINCT molecule_id, list_sort(path) AS path FROM p WHERE len(path) >= 2),
    n AS (SELECT q.molecule_id, path, count(*) AS heavy, count(*) FILTER (WHERE label = 'A') AS carbons, count(*) FILTER (WHERE label = 'R') AS aromatic
          FROM q JOIN atoms ON atoms.molecule_id = q.molecule_id AND list_contains(path, atom) GROUP BY 1, 2),
    r AS (SELECT q.molecule_id, path, count(*) - len(path) + 1 AS rings FROM q JOIN bonds ON bonds.molecule_id = q.molecule_id AND list_contains(path, a) AND list_contains(path, b) GROUP BY 1, 2)
    SELECT molecule_id, array_to_string(path, ',') AS path FROM n JOIN r USING (molecule_id, path)
    WHERE heavy >= 3 AND carbons BETWEEN 1 AND heavy - 1 AND NOT (aromatic > 0 AND rings = 0)""",
    "bonds", "atoms", recursive=True,
)
def p18_informative_paths(t: Tables) -> DataFrame:
    rows = fragments.path_metrics(fragments.atom_paths(t.bonds(), 2, 4), t.atoms(), t.bonds(), ("A",), ("R",))
    told = semantics.informative_path(*map(F.col, ("heavy_atoms", "carbon_atoms", "aromatic_atoms", "rings")))
    return rows.where(told).select("molecule_id", F.array_join("path", ",").alias("path"))


_RULES = "u AS (SELECT DISTINCT o_orderpriority AS indication, CASE o_orderkey % 3 WHEN 0 THEN 'AR' WHEN 1 THEN 'AN' END AS fragment FROM orders WHERE o_custkey % 40 = length(o_orderpriority))"


def _feature_rules(t: Tables) -> DataFrame:
    rows = t.raw("orders").where("o_custkey % 40 = length(o_orderpriority)")
    fragment = F.when(F.col("o_orderkey") % 3 == 0, " AR").when(F.col("o_orderkey") % 3 == 1, "AN ").otherwise(" ")
    return semantics.features(rows.select(F.concat(F.lit(" "), "o_orderpriority").alias("i"), fragment.alias("f")), "i", "f")


@_query(f"WITH {_RULES} SELECT indication, string_agg(fragment, ',' ORDER BY fragment) AS fragments FROM u WHERE fragment IS NOT NULL GROUP BY 1")
def s19_features_by_indication(t: Tables) -> DataFrame:
    rows = _feature_rules(t).groupBy("indication").agg(F.array_sort(F.collect_set("fragment")).alias("fragments"))
    return rows.select("indication", F.array_join("fragments", ",").alias("fragments"))


@_query(
    f"""{_RULES}, x AS (SELECT b.molecule_id, a, b, m.label AS la, n.label AS lb FROM bonds b JOIN atoms m ON m.molecule_id = b.molecule_id AND m.atom = b.a JOIN atoms n ON n.molecule_id = b.molecule_id AND n.atom = b.b)
    SELECT DISTINCT molecule_id, 'drug_feature:' || indication AS source, fragment, a || ',' || b AS atoms FROM x JOIN orders ON o_orderkey = molecule_id JOIN u ON indication = o_orderpriority AND fragment IN (la || lb, lb || la)""",
    "bonds", "atoms",
)
def c25_feature_matches(t: Tables) -> DataFrame:
    asked = t.raw("orders").select(F.col("o_orderkey").alias("molecule_id"), F.col("o_orderpriority").alias("indication"))
    patterns = {name: matching.Pattern(tuple(name), ((0, 1),)) for name in ("AR", "AN")}
    found = semantics.feature_matches(asked, _feature_rules(t), patterns, t.atoms(), t.bonds())
    return found.select("molecule_id", "source", "fragment", F.array_join("atoms", ",").alias("atoms"))


@_query("SELECT l_orderkey, lower(to_hex(bit_or(CAST(1 AS BIGINT) << CAST(l_linenumber * 8 + l_partkey % 6 AS INT)))) AS state FROM lineitem GROUP BY 1")
def f19_mask_hex(t: Tables) -> DataFrame:
    bits = t.raw("lineitem").groupBy("l_orderkey").agg(F.collect_set((F.col("l_linenumber") * 8 + F.col("l_partkey") % 6).cast("int")).alias("bits"))
    return bits.select("l_orderkey", scalars.mask_hex(F.col("bits")).alias("state"))


def _nodes(t: Tables) -> DataFrame:
    """Parts as nodes: their labels are the words of their type and name, their properties the brand, and for some the size."""
    both = F.create_map(F.lit("brand"), "p_brand", F.lit("size"), F.col("p_size").cast("string"))
    properties = F.when(F.col("p_partkey") % 3 == 0, F.create_map(F.lit("brand"), "p_brand")).otherwise(both)
    return t.raw("part").select("p_partkey", F.split(F.concat_ws(" ", "p_type", "p_name"), " ").alias("labels"), properties.alias("properties"))


@_query("SELECT p_partkey, p_brand AS brand FROM part WHERE list_contains(string_split(p_type || ' ' || p_name, ' '), 'ring')")
def s20_labelled_nodes(t: Tables) -> DataFrame:
    return graph.labelled(_nodes(t), "ring").select("p_partkey", F.col("properties")["brand"].alias("brand"))


@_query("""SELECT p_partkey, array_to_string(list_sort(string_split(p_type || ' ' || p_name, ' ')), ',') AS labels, p_brand AS brand, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS size,
    3 AS fields FROM part""")
def f29_node_payloads(t: Tables) -> DataFrame:
    node = graph.payload(F.col("labels"), F.col("properties"))
    rows = _nodes(t).select("p_partkey", node.alias("node"))
    data = graph.picked(F.col("node.properties"), ["brand", "size", "none"])
    return rows.select("p_partkey", F.array_join("node.labels", ",").alias("labels"), data["brand"].alias("brand"), data["size"].alias("size"), F.size(data).alias("fields"))


@_query("""SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN 'own' ELSE CAST(p_size AS VARCHAR) END AS size, false AS has_brand,
    2 AS fields FROM part""")
def f31_merged_records(t: Tables) -> DataFrame:
    item = F.create_map(F.lit("name"), "p_name", F.lit("size"), F.lit("own"))
    rows = _nodes(t).join(t.raw("part").select("p_partkey", item.alias("item")), "p_partkey")
    record = graph.merged(F.col("item"), F.col("properties"), "brand")
    return rows.select("p_partkey", record["name"].alias("name"), record["size"].alias("size"), F.map_contains_key(record, "brand").alias("has_brand"), F.size(record).alias("fields"))


@_query("""WITH q AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS s, o_custkey % 4 AS j, o_orderkey % 5 - 1 AS p FROM orders)
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 10 AS id, NULL AS error FROM q WHERE s <> '' AND j > 0 AND p > 0
    UNION ALL SELECT o_orderkey, NULL, CASE WHEN s = '' THEN 'source_type and aim_type cannot be empty' ELSE 'max_jump_num and max_path_num must be greater than 0' END FROM q WHERE NOT (s <> '' AND j > 0 AND p > 0)""")
def d12_path_requests(t: Tables) -> DataFrame:
    asked = t.raw("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("source_type"), F.lit("Drug").alias("aim_type"),
        (F.col("o_custkey") % 4).alias("max_jump_num"), (F.col("o_orderkey") % 5 - 1).alias("max_path_num"),
    )
    recorded, refused = audit.path_requests(asked, ["o_orderkey"], 10)
    return recorded.select("o_orderkey", "id").unionByName(refused.select("o_orderkey", "error"), allowMissingColumns=True)


@_query("""SELECT coalesce(nullif(CASE WHEN p_partkey % 5 = 0 THEN '' ELSE trim(p_name) END, ''), 'drug_' || row_number() OVER (ORDER BY p_partkey)) AS name, p_type AS smiles FROM part
    QUALIFY p_type IS NOT NULL AND p_partkey % 7 <> 0 AND row_number() OVER (ORDER BY p_partkey) > 1""")
def s08_named_smiles(t: Tables) -> DataFrame:
    sheet = ranking.numbered(t.raw("part").select("p_partkey", "p_name", "p_type"), ["p_partkey"], "n").withColumn("row", F.col("n") - 1)
    smiles = F.when(F.col("row") == 0, "TABLE").when(F.col("p_partkey") % 7 != 0, F.concat(F.lit(" "), "p_type"))
    rows = sheet.select("row", F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("name"), smiles.alias("smiles"))
    return readers.named_smiles(rows, "row", "name", "smiles")


@_query("SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def s13_rows_by_file(t: Tables) -> DataFrame:
    return readers.rows_by_file(t.spark, f"{t.folder}/lineitem.parquet").agg(F.sum("n").alias("n"))


@_query("SELECT CAST(p_partkey AS VARCHAR) AS molecule_id, trim(p_name) AS smiles FROM part")
def s01_exported_molecules(t: Tables) -> DataFrame:
    folder = f"{ingest.work_folder(t.spark)}/csv"
    sinks.export_csv(t.raw("part"), folder, ["p_partkey", "p_name", "p_brand"])
    return readers.molecules(t.spark, folder, "p_partkey", "p_name")


@_query("SELECT molecule_id, fragment_hash, atom_count FROM small", "small")
def k01_written_build(t: Tables) -> DataFrame:
    folder = f"{ingest.work_folder(t.spark)}/build"
    sinks.write_fragments(t.small(), folder)
    return t.spark.read.parquet(folder).select(F.col("molecule_id").cast("string").alias("molecule_id"), "fragment_hash", "atom_count")


@_query("SELECT CAST(event_id AS VARCHAR) AS request_id, event_type AS method, CAST(user_id AS VARCHAR) AS user_id, 200 AS status_code FROM events")
def k17_audit_records(t: Tables) -> DataFrame:
    folder = f"{ingest.work_folder(t.spark)}/audit"
    records = t.raw("events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.col("event_id").cast("string").alias("request_id"),
        F.col("event_type").alias("method"), F.col("user_id").cast("string").alias("user_id"), F.lit(200).alias("status_code"),
    )
    sinks.append_audit(records, folder)
    return readers.audit_records(t.spark, folder).select("request_id", "method", "user_id", "status_code")


@_query("SELECT batch, count(*) AS fragment_rows, count(DISTINCT fragment_hash) AS fragments FROM (SELECT * FROM small UNION ALL SELECT * FROM big) GROUP BY 1", "small", "big")
def d01_views(t: Tables) -> DataFrame:
    return warehouse.with_views(
        t.spark, "SELECT batch, count(*) AS fragment_rows, count(DISTINCT fragment_hash) AS fragments FROM {unified} GROUP BY batch", unified="SELECT * FROM {small} UNION ALL SELECT * FROM {big}", small=t.small(), big=t.big()
    )


# Compounds drawn as SMILES: what their pieces hold adds up


_PIECES = """h(head, heavy, hetero, nonring, branches, hydroxyl, carboxyl, amine, thioether, nitrile, nitro) AS (VALUES
      ('CCC', 3, 0, 2, 0, 0, 0, 0, 0, 0, 0), ('OCC', 3, 1, 2, 0, 1, 0, 0, 0, 0, 0), ('NCC', 3, 1, 2, 0, 0, 0, 1, 0, 0, 0), ('N#CCC', 4, 1, 3, 0, 0, 0, 0, 0, 1, 0),
      ('CC(C)C', 4, 0, 3, 1, 0, 0, 0, 0, 0, 0), ('OC(=O)C', 4, 2, 3, 1, 1, 1, 0, 0, 0, 0), ('[O-][N+](=O)C', 4, 3, 3, 1, 0, 0, 1, 0, 0, 1), ('CSC', 3, 1, 2, 0, 0, 0, 0, 1, 0, 0)),
    c(core, heavy, rings, aromatic, hetero, nonring, rotatable, branches, amide, ether, benzene) AS (VALUES
      ('c1ccccc1', 6, 1, 1, 0, 0, 0, 2, 0, 0, true), ('c1ccc2ccccc2c1', 10, 2, 2, 0, 0, 0, 4, 0, 0, true), ('C1CCCCC1', 6, 1, 0, 0, 0, 0, 2, 0, 0, false), ('C(=O)N', 3, 0, 0, 2, 2, 0, 1, 1, 0, false),
      ('COC', 3, 0, 0, 1, 2, 2, 0, 0, 1, false), ('c1ccccc1c1ccccc1', 12, 2, 2, 0, 1, 1, 4, 0, 0, true), ('c1ccsc1', 5, 1, 1, 1, 0, 0, 2, 0, 0, false), ('C1CC(=O)CCC1', 7, 1, 0, 1, 1, 0, 3, 0, 0, false)),
    e(tail, heavy, hetero, nonring, rotatable, branches, hydroxyl, carboxyl, amine, amide, nitrile) AS (VALUES
      ('CC', 2, 0, 1, 0, 0, 0, 0, 0, 0, 0), ('CO', 2, 1, 1, 0, 0, 1, 0, 0, 0, 0), ('CN', 2, 1, 1, 0, 0, 0, 0, 1, 0, 0), ('CC#N', 3, 1, 2, 0, 0, 0, 0, 0, 0, 1),
      ('CC(=O)O', 4, 2, 3, 1, 1, 1, 1, 0, 0, 0), ('CC(N)=O', 4, 2, 3, 1, 1, 0, 0, 0, 1, 0)),
    x AS (SELECT * FROM compounds JOIN h USING (head) JOIN c USING (core) JOIN e USING (tail))"""


def _molecules(t: Tables) -> DataFrame:
    return smiles.with_rings(smiles.molecules(t.compounds()))


@_query(
    f"""{_PIECES}, n AS (SELECT molecule_id, h.heavy + c.heavy + e.heavy AS heavy_atoms, rings, aromatic AS aromatic_rings, h.hetero + c.hetero + e.hetero AS hetero_atoms,
      h.nonring + c.nonring + e.nonring + 2 AS nonring_bonds, 1 + c.rotatable + e.rotatable + 2 AS rotatable_bonds, h.branches + c.branches + e.branches AS branches, benzene AS has_benzene
      FROM compounds JOIN h USING (head) JOIN c USING (core) JOIN e USING (tail))
    SELECT *, round(0.23 * nonring_bonds + 0.13 * rotatable_bonds + 0.06 * branches + 0.04 * heavy_atoms + 0.02 * hetero_atoms, 6) AS score FROM n""",
    "compounds",
)
def c31_molecule_features(t: Tables) -> DataFrame:
    return smiles.features(_molecules(t)).withColumn("score", F.round("score", 6))


@_query(
    f"""{_PIECES}, g AS (SELECT molecule_id, unnest(['hydroxyl', 'carboxyl', 'amide', 'amine', 'ether', 'thioether', 'nitrile', 'nitro']) AS name,
      unnest([h.hydroxyl + e.hydroxyl, h.carboxyl + e.carboxyl, c.amide + e.amide, h.amine + e.amine, ether, thioether, h.nitrile + e.nitrile, nitro]) AS n
      FROM compounds JOIN h USING (head) JOIN c USING (core) JOIN e USING (tail))
    SELECT molecule_id, name, CAST(n AS BIGINT) AS n FROM g WHERE n > 0""",
    "compounds",
)
def c20_functional_groups(t: Tables) -> DataFrame:
    def told(rows: DataFrame) -> DataFrame:
        rows = settled(smiles.molecules(rows))
        found = patterns.matches(patterns.FUNCTIONAL_GROUPS, smiles.atoms_of(rows), smiles.bonds_of(rows))
        return found.groupBy("molecule_id", "name").agg(F.count("*").alias("n"))

    return smiles.once(t.compounds(), told)


@_query(
    """SELECT 'two nitriles' AS search, molecule_id FROM compounds WHERE head = 'N#CCC' AND tail = 'CC#N'
    UNION ALL SELECT 'acid with a ring', molecule_id FROM compounds WHERE (head = 'OC(=O)C' OR tail = 'CC(=O)O') AND core IN ('c1ccccc1', 'c1ccc2ccccc2c1', 'c1ccccc1c1ccccc1')
    UNION ALL SELECT 'thiophene', molecule_id FROM compounds WHERE core = 'c1ccsc1'
    UNION ALL SELECT 'amide and nitro', molecule_id FROM compounds WHERE head = '[O-][N+](=O)C' AND (core = 'C(=O)N' OR tail = 'CC(N)=O')""",
    "compounds",
)
def e01_smiles_search(t: Tables) -> DataFrame:
    searches = {"two nitriles": ["N#C", "N#C"], "acid with a ring": ["c1ccccc1", "C(=O)O"], "thiophene": ["c1ccsc1"], "amide and nitro": ["NC=O", "[N+](=O)[O-]"]}

    def told(rows: DataFrame) -> DataFrame:
        rows = settled(smiles.molecules(rows))
        return patterns.holding(searches, smiles.atoms_of(rows), smiles.bonds_of(rows))

    return smiles.once(t.compounds(), told)


@_query(f"{_PIECES} SELECT molecule_id, CAST(c.heavy AS INT) AS n, CAST(h.heavy AS INT) AS first FROM compounds JOIN h USING (head) JOIN c USING (core) WHERE rings > 0", "compounds")
def c24_scaffolds(t: Tables) -> DataFrame:
    found = skeletons.scaffold(_molecules(t))
    return found.select("molecule_id", F.size("atoms").alias("n"), F.array_min("atoms").alias("first"))


@_query(f"{_PIECES} SELECT molecule_id, CAST(heavy AS INT) AS heavy_atoms, rings AS ring_count, aromatic AS aromatic_ring_count, benzene AS has_benzene FROM compounds JOIN c USING (core) WHERE rings > 0", "compounds")
def c17_subset_metrics(t: Tables) -> DataFrame:
    def told(rows: DataFrame) -> DataFrame:
        rows = settled(smiles.with_rings(smiles.molecules(rows)))
        return skeletons.subset_metrics(skeletons.scaffold(rows), rows).drop("atoms")

    return smiles.once(t.compounds(), told)


@_query(
    f"""{_PIECES}, m AS (SELECT *, p_partkey % 3 AS salt FROM compounds JOIN part ON p_partkey = molecule_id)
    SELECT molecule_id, CASE WHEN salt = 2 AND h.heavy + c.heavy + e.heavy <= 14 THEN 'c1ccc2cc3ccccc3cc2c1' ELSE head || core || tail END AS largest
    FROM m JOIN h USING (head) JOIN c USING (core) JOIN e USING (tail)""",
    "compounds",
)
def f06_largest_part(t: Tables) -> DataFrame:
    salt = F.get(F.array(*map(F.lit, ("", ".[Na+].[Cl-]", ".oops.c1ccc2cc3ccccc3cc2c1"))), (F.col("molecule_id") % 3).cast("int"))
    whole = F.when(salt.endswith("c1"), F.concat(F.substring(salt, 2, 99), F.lit("."), F.col("smiles"))).otherwise(F.concat("smiles", salt))
    return t.compounds().select("molecule_id", smiles.largest_part(whole).alias("largest"))


@_query(
    """SELECT molecule_id, CASE residue WHEN 0 THEN 'glycine' WHEN 3 THEN 'proline' ELSE 'amino_acid_like' END AS name,
      CASE residue WHEN 0 THEN 'special' WHEN 3 THEN 'hydrophobic' ELSE 'unclassified' END AS class,
      CAST(4 + residue + CAST(last AS INT) AS INT) AS atoms, CAST(residue AS INT) AS side_chain FROM residues""",
    "residues",
)
def c18_residues(t: Tables) -> DataFrame:
    sizes = F.size("atoms").alias("atoms"), F.size("side_chain").alias("side_chain")
    return smiles.once(t.peptides(), lambda rows: skeletons.residues(smiles.with_rings(smiles.molecules(rows))).select("molecule_id", "name", "class", *sizes))


# Rings are cut from both sides and from each other, ethers and the bond of an amide within, its nitrogen from a carbon with a carbon, and a sulfide from what follows.
@_query(
    """SELECT molecule_id, CAST(CASE core WHEN 'COC' THEN 2 WHEN 'C(=O)N' THEN 1 + CAST(tail NOT IN ('CO', 'CN') AS INT) WHEN 'c1ccccc1c1ccccc1' THEN 3 ELSE 2 END
      + CAST(head = 'CSC' AS INT) AS BIGINT) AS n FROM compounds""",
    "compounds",
)
def c23_cuts(t: Tables) -> DataFrame:
    found = skeletons.cuts(_molecules(t)).groupBy("molecule_id").agg(F.count("*").alias("n"))
    return t.compounds().select("molecule_id").join(found, "molecule_id", "left").select("molecule_id", F.coalesce("n", F.lit(0)).alias("n"))


@_query("SELECT molecule_id, true AS same, count(*) OVER (PARTITION BY head, core, tail) AS copies FROM compounds", "compounds")
def c02_canonical_texts(t: Tables) -> DataFrame:
    atoms, bonds, n = F.col("molecule.atoms"), F.col("molecule.bonds"), F.size("molecule.atoms")
    # The same molecule with its atoms numbered from the other end.
    turned = F.transform(atoms, lambda x: x.withField("atom", n - 1 - x["atom"]))
    ends = F.transform(bonds, lambda x: x.withField("a", n - 1 - x["a"]).withField("b", n - 1 - x["b"]))

    def told(rows: DataFrame) -> DataFrame:
        """Each text once, with the molecules that have its canonical one."""
        texts = settled(smiles.molecules(rows).select("molecule_id", "rows", canonical.canonical_smiles(atoms, bonds).alias("text"), canonical.canonical_smiles(turned, ends).alias("other")))
        counts = texts.groupBy("text").agg(F.sum("rows").alias("copies"))
        return texts.join(counts.hint("merge"), "text").select("molecule_id", (F.col("text") == F.col("other")).alias("same"), "copies")

    return smiles.once(t.compounds(), told)


@_query(f"{_PIECES} SELECT core, count(*) AS n, CAST(1 AS BIGINT) AS texts FROM compounds JOIN c USING (core) WHERE rings > 0 GROUP BY 1", "compounds")
def c15_scaffold_texts(t: Tables) -> DataFrame:
    def told(rows: DataFrame) -> DataFrame:
        rows = settled(smiles.with_rings(smiles.molecules(rows)))
        found = rows.join(skeletons.scaffold(rows).hint("merge"), "molecule_id")
        return found.select("molecule_id", canonical.fragment_smiles(F.col("molecule.atoms"), F.col("molecule.bonds"), F.col("atoms")).alias("text"))

    found = smiles.once(t.compounds(), told)
    names = t.raw("part").select(F.col("p_partkey").alias("molecule_id"), F.get(F.array(*map(F.lit, CORES)), (F.col("p_size") % len(CORES)).cast("int")).alias("core"))
    return found.join(names.hint("merge"), "molecule_id").groupBy("core").agg(F.count("*").alias("n"), F.count_distinct("text").alias("texts"))


# Drugs by contained names, and a view kept up to date


_EFFECT_TERMS = "a AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS name FROM part UNION SELECT 'NO SUCH ' || n_name FROM nation)"


@_query(
    f"""WITH {_EFFECT_TERMS}, m AS (SELECT name, p_partkey, p_brand FROM a JOIN part ON contains(lower(p_name), lower(name))),
    i AS (SELECT DISTINCT name, 's' || l_suppkey AS indication, s_nationkey FROM m JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey),
    x AS (SELECT name, string_agg(DISTINCT indication, ',' ORDER BY indication) AS indications, string_agg(DISTINCT 'n' || s_nationkey, ',' ORDER BY 'n' || s_nationkey) AS features FROM i GROUP BY 1),
    y AS (SELECT name, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS targets FROM m GROUP BY 1)
    SELECT name, y.name IS NOT NULL AS drug_found, coalesce(indications, '') AS indications, coalesce(features, '') AS features, coalesce(targets, '') AS targets FROM a LEFT JOIN x USING (name) LEFT JOIN y USING (name)"""
)
def e02_effects(t: Tables) -> DataFrame:
    part = t.raw("part")
    names = part.select(F.split("p_name", " ")[0].alias("name")).union(t.raw("nation").select(F.concat(F.lit("NO SUCH "), "n_name"))).distinct()
    drug = lambda c: F.concat(F.lit("p"), c)
    edges = (
        t.raw("lineitem").select(drug("l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"), F.lit("TREATS").alias("type"))
        .union(t.raw("supplier").select(F.concat(F.lit("n"), "s_nationkey"), F.concat(F.lit("s"), "s_suppkey"), F.lit("HAS_CLINICAL_FEATURE")))
        .union(part.select(drug("p_partkey"), "p_brand", F.lit("TARGETS")))
    )
    rows = graph.effects(names, part.select(drug("p_partkey").alias("drug"), F.col("p_name").alias("drug_name")), edges)
    line = lambda c, out: F.array_join(c, ",").alias(out)
    return rows.select("name", "drug_found", line("indication_name", "indications"), line("feature_name", "features"), line("target_name", "targets"))


_KEPT_UP = """s AS (SELECT 'small' AS source, * FROM small UNION ALL SELECT 'big', * FROM big),
    f AS (SELECT * FROM s WHERE NOT (batch = 1993 AND source = 'big') AND molecule_id NOT LIKE '%7'),
    i AS (SELECT molecule_id, CASE WHEN molecule_id LIKE '%3' THEN 'renamed' ELSE ingredient_name END AS ingredient_name FROM ingredients WHERE molecule_id NOT LIKE '%9')"""


@_query(
    f"""{_KEPT_UP} SELECT source, molecule_id, fragment_hash, ingredient_name, {_CARRIED}, count(*) AS occurrence_count
    FROM f LEFT JOIN i USING (molecule_id) GROUP BY source, molecule_id, fragment_hash, ingredient_name""",
    "small", "big", "ingredients",
)
def d01_maintained_view(t: Tables) -> DataFrame:
    """Small fragments and all ingredients come first, then the big ones and new names; then a batch, some molecules and some names go."""
    rows = t.small().withColumn("source", F.lit("small")).unionByName(t.big().withColumn("source", F.lit("big")))
    names, ends = t.ingredients(), lambda x: F.col("molecule_id").endswith(x)
    small, big = rows.where("source = 'small'"), rows.where("source = 'big'")
    gone = rows.where((F.col("batch") == 1993) & (F.col("source") == "big") | ends("7"))
    state = maintained.empty(rows, names)
    steps = [
        (maintained.inserted(small), maintained.inserted(names)),
        (maintained.inserted(big), maintained.replaced(names.where(ends("3")), names.where(ends("3")).withColumn("ingredient_name", F.lit("renamed")))),
        (maintained.deleted(gone), maintained.deleted(names.where(ends("9")))),
    ]
    folder = ingest.work_folder(t.spark)
    for step, (fragments_changed, names_changed) in enumerate(steps):
        state = maintained.written(maintained.changed(state, fragments_changed, names_changed), f"{folder}/{step}")
    return state.view


# All atoms of a peptide lie in its residues, so these alone are kept, one of each text; the last has an oxygen more.
@_query("SELECT molecule_id, 'amino_acid_residue' AS semantic_type, true AS stop_decompose, count(DISTINCT (residue, last)) AS n FROM residues GROUP BY 1", "residues")
def c29_semantic_split(t: Tables) -> DataFrame:
    def told(rows: DataFrame) -> DataFrame:
        found = split.semantic_split(smiles.with_rings(smiles.molecules(rows)), (3, 5))
        return found.groupBy("molecule_id", "semantic_type", "stop_decompose").agg(F.count("*").alias("n"))

    return smiles.once(t.peptides(), told)

"""The warehouse, dialogue, graph and build tables, as views of the given tables; SQL has the same views by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: What compounds are put together from, by a part's key and size: each begins and ends with an atom that is bonded on.
HEADS = ("CCC", "OCC", "NCC", "N#CCC", "CC(C)C", "OC(=O)C", "[O-][N+](=O)C", "CSC")
CORES = ("c1ccccc1", "c1ccc2ccccc2c1", "C1CCCCC1", "C(=O)N", "COC", "c1ccccc1c1ccccc1", "c1ccsc1", "C1CC(=O)CCC1")
TAILS = ("CC", "CO", "CN", "CC#N", "CC(=O)O", "CC(N)=O")

#: Residues as SMILES, by a part's key: glycine, alanine, serine, proline.
RESIDUES = ("NCC(=O)", "NC(C)C(=O)", "NC(CO)C(=O)", "N1CCCC1C(=O)")


class Tables:
    """The given tables of a folder and the views of them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def fragments(self) -> DataFrame:
        """A fragment for each line: the supplier is the molecule, the part's name the SMILES."""
        parts = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        lines = self.raw("lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
        return lines.join(parts, "l_partkey").select(
            F.col("l_suppkey").cast("string").alias("molecule_id"),
            F.sha2("p_name", 256).alias("fragment_hash"),
            F.col("p_name").alias("canonical_smiles"),
            F.length("p_name").alias("atom_count"),
            (F.length("p_name") - 1).alias("bond_count"),
            "l_returnflag",
            F.year("l_shipdate").alias("batch"),
        )

    def small(self) -> DataFrame:
        return self.fragments().where("l_returnflag = 'A'").drop("l_returnflag")

    def big(self) -> DataFrame:
        return self.fragments().where("l_returnflag <> 'A'").drop("l_returnflag")

    def ingredients(self) -> DataFrame:
        nations = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("ingredient_name"))
        rows = self.raw("supplier").join(nations, "s_nationkey")
        return rows.select(F.col("s_suppkey").cast("string").alias("molecule_id"), "ingredient_name")

    def ingredients_twice(self) -> DataFrame:
        """Each fifth molecule's ingredient stands twice."""
        rows = self.ingredients()
        return rows.unionByName(rows.where(F.col("molecule_id").cast("int") % 5 == 0))

    def users(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"), F.col("c_mktsegment").alias("segment"))

    def dialogues(self) -> DataFrame:
        rows = self.raw("orders")
        return rows.select(
            F.col("o_orderkey").alias("dialogue_id"),
            F.col("o_custkey").alias("user_id"),
            (F.col("o_orderstatus") == "F").alias("is_deleted"),
            F.col("o_orderpriority").alias("title"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def turns(self) -> DataFrame:
        rows = self.raw("lineitem")
        turn = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("turn_id")
        return rows.select(F.col("l_orderkey").alias("dialogue_id"), turn, F.col("l_linenumber").alias("turn_no"), F.col("l_returnflag").alias("kind"), F.col("l_partkey").alias("part"))

    def reviews(self) -> DataFrame:
        rows = self.raw("documents").join(self.raw("labels"), "doc_id")
        return rows.select(
            "doc_id",
            F.when(F.col("quality") == 1, "done").otherwise("open").alias("status"),
            (F.col("toxic") - F.when(F.col("quality") == 0, 1).otherwise(0)).alias("judge_conclusion"),
            F.col("text").alias("question"),
            F.col("source").alias("answer"),
            F.col("lang").alias("comment"),
        )

    def bonds(self) -> DataFrame:
        """An order is a molecule: its lines are atoms, bonded in order, the first also to the third."""
        lines = self.raw("lineitem").select(F.col("l_orderkey").alias("molecule_id"), F.col("l_linenumber").alias("a")).distinct()
        ahead = lines.select("molecule_id", F.col("a").alias("b"))
        pairs = lines.join(ahead, "molecule_id").where((F.col("b") == F.col("a") + 1) | ((F.col("a") == 1) & (F.col("b") == 3)))
        return pairs.select("molecule_id", "a", "b")

    def compounds(self) -> DataFrame:
        """A part is a compound: its key and size choose head, core and tail of a SMILES text."""
        key, size = F.col("p_partkey"), F.col("p_size")
        of = lambda pieces, at: F.get(F.array(*map(F.lit, pieces)), at.cast("int"))
        text = F.concat(of(HEADS, key % len(HEADS)), of(CORES, size % len(CORES)), of(TAILS, F.floor(key / len(HEADS)) % len(TAILS)))
        return self.raw("part").select(key.alias("molecule_id"), text.alias("smiles"))

    def peptides(self) -> DataFrame:
        """An order is a peptide: its lines choose its residues, in order."""
        lines = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
        residue = F.get(F.array(*map(F.lit, RESIDUES)), (F.col("part") % len(RESIDUES)).cast("int"))
        rows = lines.groupBy(F.col("l_orderkey").alias("molecule_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", residue.alias("r")))).alias("rs"))
        return rows.select("molecule_id", F.concat(F.array_join(F.transform("rs", lambda x: x["r"]), ""), F.lit("O")).alias("smiles"))

    def atoms(self) -> DataFrame:
        rows = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("molecule_id"), F.col("l_linenumber").alias("atom"))
        return rows.agg(F.min("l_returnflag").alias("label"))


#: The same views for DuckDB; each query's SQL begins with those it names.
VIEWS = {
    "fragments": """SELECT CAST(l_suppkey AS VARCHAR) AS molecule_id, sha256(p_name) AS fragment_hash, p_name AS canonical_smiles,
        length(p_name) AS atom_count, length(p_name) - 1 AS bond_count, l_returnflag, year(l_shipdate) AS batch
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "small": "SELECT * EXCLUDE (l_returnflag) FROM fragments WHERE l_returnflag = 'A'",
    "big": "SELECT * EXCLUDE (l_returnflag) FROM fragments WHERE l_returnflag <> 'A'",
    "ingredients": "SELECT CAST(s_suppkey AS VARCHAR) AS molecule_id, n_name AS ingredient_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "ingredients_twice": "SELECT * FROM ingredients UNION ALL SELECT * FROM ingredients WHERE CAST(molecule_id AS INT) % 5 = 0",
    "users": "SELECT c_custkey AS user_id, c_name AS username, c_mktsegment AS segment FROM customer",
    "dialogues": "SELECT o_orderkey AS dialogue_id, o_custkey AS user_id, o_orderstatus = 'F' AS is_deleted, o_orderpriority AS title, o_orderdate AS updated_at FROM orders",
    "turns": "SELECT l_orderkey AS dialogue_id, l_orderkey * 10 + l_linenumber AS turn_id, l_linenumber AS turn_no, l_returnflag AS kind, l_partkey AS part FROM lineitem",
    "reviews": """SELECT doc_id, CASE WHEN quality = 1 THEN 'done' ELSE 'open' END AS status,
        toxic - CASE WHEN quality = 0 THEN 1 ELSE 0 END AS judge_conclusion, text AS question, source AS answer, lang AS comment
        FROM documents JOIN labels USING (doc_id)""",
    "bonds": """SELECT DISTINCT x.l_orderkey AS molecule_id, x.l_linenumber AS a, y.l_linenumber AS b FROM lineitem x JOIN lineitem y
        ON x.l_orderkey = y.l_orderkey AND (y.l_linenumber = x.l_linenumber + 1 OR (x.l_linenumber = 1 AND y.l_linenumber = 3))""",
    "compounds": f"""SELECT p_partkey AS molecule_id, ({list(HEADS)})[p_partkey % {len(HEADS)} + 1] AS head, ({list(CORES)})[p_size % {len(CORES)} + 1] AS core,
        ({list(TAILS)})[p_partkey // {len(HEADS)} % {len(TAILS)} + 1] AS tail FROM part""",
    "residues": """SELECT l_orderkey AS molecule_id, l_linenumber AS place, min(l_partkey) % 4 AS residue,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) = 1 AS last FROM lineitem GROUP BY 1, 2""",
    "atoms": "SELECT l_orderkey AS molecule_id, l_linenumber AS atom, min(l_returnflag) AS label FROM lineitem GROUP BY 1, 2",
}


def with_views(sql: str, *names: str, recursive: bool = False) -> str:
    """SQL with the named views before it."""
    needed = [n for n in VIEWS if n in names or (n == "fragments" and {"small", "big"} & set(names)) or (n == "ingredients" and "ingredients_twice" in names)]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed) + ("\n" + sql if sql.lstrip().startswith(("SELECT", "(")) else ",\n" + sql)

"""Property graphs as node and edge tables: name matching, undirected hops and pages of details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragmill.operators.ranking import last

MAX_PAGE = 2000


def undirected(edges: DataFrame) -> DataFrame:
    """Edges (src, dst, type) in both directions."""
    return edges.select("src", "dst", "type").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type"))


def hop(nodes: DataFrame, edges: DataFrame, kind: str, at: str, to: str) -> DataFrame:
    """Nodes left-joined to what an undirected edge of a kind reaches; null where there is none. Edges are many, so they are never broadcast."""
    step = undirected(edges.where(F.col("type") == kind)).select(F.col("src").alias(at), F.col("dst").alias(to))
    return nodes.join(step.hint("merge"), at, "left")


def gathered(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Distinct values of each key, sorted; an empty array where all are null. Values are made one before they are gathered, so no task sees a key's rows."""
    return rows.select(*keys, value).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(out))


def ordered_union(rows: DataFrame, key: str, order: str, values: str, out: str) -> DataFrame:
    """(key, out): the values of all arrays of a key, each once, in the order they first come up by row and place.

    Values are made one by an aggregate before they are gathered, so a frequent key
    gathers its different values only.
    """
    each = rows.select(key, order, F.posexplode(values).alias("_at", "_value")).where("_value is not null")
    seen = each.groupBy(key, "_value").agg(F.min(F.struct(order, "_at")).alias("_place"))
    return seen.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_value"))), lambda x: x["_value"]).alias(out))


def details(matches: DataFrame, drugs: DataFrame, related: DataFrame, key: str, node: str, fields: list[str], other: str, out: str) -> DataFrame:
    """matches with drug_found, data (map of the given fields) and out, what the drug is related to, sorted.

    Of several drugs of one key the last by node counts. A match without a drug has
    an empty map and an empty array.
    """
    one = last(drugs.select(key, node, *fields), [key], [node])
    near = related.groupBy(node).agg(F.array_sort(F.collect_set(other)).alias(out))
    picked = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    rows = matches.join(one.join(near, node, "left"), key, "left")
    found = F.col(node).isNotNull()
    none = F.create_map().cast("map<string,string>")
    return rows.select(*matches.columns, found.alias("drug_found"), F.when(found, picked).otherwise(none).alias("data"), F.coalesce(out, F.array().cast(near.schema[out].dataType)).alias(out))


def effects(names: DataFrame, drugs: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, drug_found, indication_name, feature_name, target_name): of all drugs whose name contains a name, in any case, what their edges reach, each value once and sorted.

    names (name), drugs (drug, drug_name), edges (src, dst, type): TREATS from a drug
    to indications, HAS_CLINICAL_FEATURE from these to features, TARGETS from a drug
    to targets, all undirected. A blank name finds nothing. The three ways are
    gathered apart, so that one does not multiply the others.
    """
    asked = names.select("name").where("name is not null").distinct()
    found = containing(drugs.select("drug", "drug_name"), "drug_name", asked, "name").select("name", "drug").distinct()
    treats = hop(found, edges, "TREATS", "drug", "indication")
    ways = {
        "indication_name": gathered(treats, ["name"], "indication", "indication_name"),
        "feature_name": gathered(hop(treats.select("name", "indication").distinct(), edges, "HAS_CLINICAL_FEATURE", "indication", "feature"), ["name"], "feature", "feature_name"),
        "target_name": gathered(hop(found, edges, "TARGETS", "drug", "target"), ["name"], "target", "target_name"),
    }
    rows = asked
    for way in ways.values():
        rows = rows.join(way, "name", "left")
    return rows.select("name", F.col("indication_name").isNotNull().alias("drug_found"), *(F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ways))


def labelled(nodes: DataFrame, label: str) -> DataFrame:
    """Nodes (labels array) that carry a label."""
    return nodes.where(F.array_contains("labels", label))


def payload(labels: Column, properties: Column) -> Column:
    """A node as labels, sorted, and properties; without labels and properties where the node is null."""
    return F.when(labels.isNotNull() | properties.isNotNull(), F.struct(F.array_sort(labels).alias("labels"), properties.alias("properties")))


def picked(properties: Column, fields: list[str]) -> Column:
    """A map of the given fields, with null for those that the properties lack."""
    return F.create_map(*[x for f in fields for x in (F.lit(f), F.try_element_at(properties, F.lit(f)))])


def merged(one: Column, other: Column, without: str | None = None) -> Column:
    """The entries of two maps, the other's where both have a key, and none of the key without."""
    kept = lambda key: F.lit(True) if without is None else key != without
    mine = F.map_filter(one, lambda key, _: kept(key) & ~F.map_contains_key(other, key))
    return F.map_concat(mine, F.map_filter(other, lambda key, _: kept(key)))


def words(text: Column) -> Column:
    """The words of a name, lower-cased."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def containing(names: DataFrame, name: str, terms: DataFrame, term: str) -> DataFrame:
    """(name row, term row) where the lower-cased name contains the lower-cased term, as a substring.

    Both sides meet at a common run of three characters, so that no pair is tried
    that shares none: a term is looked up by its first run alone, a name offers all
    of its runs once each. A term shorter than that meets names at its own text,
    which they offer likewise. Each different name is looked at once and meets its
    rows in a merge join, and so do the runs: a small file may hold very many names,
    so its size is no reason to broadcast them.
    """
    rows = names.withColumn("_low", F.lower(F.coalesce(F.col(name), F.lit(""))))
    low_name, low_term = F.col("_low"), F.lower(F.col(term))
    grams = lambda n: F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(low_name) - (n - 1), F.lit(1))), lambda i: F.substring(low_name, i, F.lit(n))
    )
    offers = F.array_distinct(F.concat(grams(1), grams(2), grams(3)))
    left = rows.select("_low").distinct().withColumn("_run", F.explode(offers))
    right = terms.where(low_term != "").withColumn("_run", F.left(low_term, F.lit(3)))
    found = left.hint("merge").join(right, "_run").where(F.contains(low_name, low_term)).drop("_run")
    return rows.hint("merge").join(found, "_low").drop("_low")


def last_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key that comes last by an order without ties."""
    return last(rows, [key], [order])


def page(rows: DataFrame, order: list[str], offset: int = 0, limit: int = 100) -> DataFrame:
    """One page of rows in a stated order."""
    if offset < 0 or not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"offset must be 0 or more and limit from 1 to {MAX_PAGE}")
    return rows.orderBy(*order).offset(offset).limit(limit)

"""Document fingerprints by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions

#: Characters of a gram, and grams of a window: each power of two, as both double.
GRAM = 8
WINDOW = 32
_LOW = 0xFFFFFFFF
#: Odd multipliers of the rolling hash, one for each doubling; products stay below 2^63.
_FACTORS = (747796405, 277803737, 461845907)
_PLACE = (1 << 31) - 1


def _beside(values: str, step: int, join) -> Column:
    """Each value joined with the one so many places on; null beyond the end."""
    return F.zip_with(values, F.slice(F.col(values), F.lit(step + 1), F.greatest(F.size(values), F.lit(1))), join)


def _rolled(factor: int):
    return lambda a, b: (a * factor + b).bitwiseAND(_LOW)


def with_minima(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """df with out, array<bigint>: the least gram of each window, as its hash above its place counted from the end of 31 bits.

    Rolling sums and minima double their reach with each step, so a text costs a
    fixed number of passes over its characters, whatever the gram and window.
    """
    v, n = f"_v_{out}", f"_n_{out}"
    frame = df.withColumn(n, F.coalesce(F.char_length(text_col), F.lit(0)))
    frame = frame.withColumn(
        v, F.transform(F.split(F.coalesce(text_col, F.lit("")), ""), lambda c: F.xxhash64(c).bitwiseAND(_LOW))
    )
    step = 1
    for factor in _FACTORS:
        frame = frame.withColumn(v, _beside(v, step, _rolled(factor)))
        step *= 2
    grams = F.when(F.col(n) >= GRAM, F.slice(F.col(v), F.lit(1), F.greatest(F.col(n) - (GRAM - 1), F.lit(1)))).otherwise(
        F.array(F.xxhash64(text_col).bitwiseAND(_LOW))
    )
    frame = frame.withColumn(v, grams).withColumn(
        v, F.transform(v, lambda h, i: F.xxhash64(h).bitwiseOR(F.lit(_PLACE).cast("bigint")) - i)
    )
    step = 1
    while step < WINDOW:
        frame = frame.withColumn(v, _beside(v, step, lambda a, b: F.least(a, b)))
        step *= 2
    whole = F.slice(F.col(v), F.lit(1), F.greatest(F.size(v) - (WINDOW - 1), F.lit(1)))
    return frame.withColumn(out, F.when(F.col(n) == 0, F.array().cast("array<bigint>")).otherwise(whole)).drop(v, n)


def begun(minima: Column, before: Column) -> Column:
    """Of a text's different minima, in order, those of the windows that begin before a place; all these windows are full."""

    def at(x: Column) -> Column:
        return F.lit(_PLACE) - x.bitwiseAND(_PLACE)

    def start(x: Column, i: Column) -> Column:
        # A lesser gram is the minimum once a window reaches it, a greater one once the minimum before it is left behind.
        last = F.get(minima, i - 1)
        return F.coalesce(F.when(x < last, at(x) - (WINDOW - 1)).otherwise(at(last) + 1), F.lit(0))

    # Starts ascend; the place is sorted among them, as a lambda would work it out again for each.
    before = F.greatest(before, F.lit(0)).cast("bigint")
    ranks = F.sort_array(F.concat(F.transform(minima, start), F.array(before)))
    return F.slice(minima, F.lit(1), F.array_position(ranks, before).cast("int") - 1)


def placed(minima: Column) -> Column:
    """array<struct<hash, at>> of the different minima, in order."""
    return F.transform(
        minima,
        lambda x: F.struct(F.shiftright(x, 31).alias("hash"), (F.lit(_PLACE) - x.bitwiseAND(_PLACE)).cast("int").alias("at")),
    )


def with_winnowed(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """df with out, array<struct<hash, at>>: the grams of the text that winnowing keeps, in order.

    Grams are eight code points, windows 32 grams; each window keeps its least
    hash, the rightmost of equals, and a gram kept by several windows stands once.
    Two texts that share 39 characters so share a hash. A text with fewer grams is
    one window, one with fewer characters is one gram, and an empty or null text
    has none. Hashes are signed, 33 bits of a hash of the 32-bit rolling one; at counts from 0.
    """
    m = f"_m_{out}"
    return with_minima(df, text_col, m).withColumn(out, placed(F.array_distinct(m))).drop(m)


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard likeness of the hashes of two texts' minima; 1 if neither has any."""
    a, b = (F.array_distinct(F.transform(x, lambda g: F.shiftright(g, 31))) for x in (a, b))
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def digest(kept: Column) -> Column:
    """128 bits of a fingerprint's hashes and places, in hex."""
    return F.md5(F.array_join(F.transform(kept, lambda g: F.concat_ws(":", g["hash"].cast("string"), g["at"].cast("string"))), " "))


def dealt_by_range(df: DataFrame, key: str) -> DataFrame:
    """The rows of df dealt so that following() finds what follows each by ascending key; the first follows the last.

    Rows go to ranges of the key, and the first row of each range also to
    the one before, so that each range finds all its successors itself: one
    shuffle, and no task holds more than a range. Null keys come first.
    """
    spark = df.sparkSession
    n = 4 * partitions(spark)
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    places = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    ranged = df.withColumn("_range", F.size(F.filter(places, lambda c: F.col(key) >= c)))
    ranged = ranged.withColumn("_range", F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.col("_range")))
    # One row for each range at most: the number of partitions bounds what is broadcast.
    first = F.min(F.struct(F.col(key).isNotNull().alias("some"), F.col(key).alias("key")))
    heads = ranged.groupBy("_range").agg(first.alias("head")).collect()
    heads = sorted((r["_range"], r["head"]["key"]) for r in heads)
    links = [(at, k, heads[i - 1][0]) for i, (at, k) in enumerate(heads)]
    kind = df.schema[key].dataType.simpleString()
    before = spark.createDataFrame(links, f"_range int, _key {kind}, _before int")
    copies = ranged.join(F.broadcast(before), "_range", "left").withColumn(
        "_to",
        F.when(
            F.col(key).eqNullSafe(F.col("_key")),
            F.array(F.struct(F.lit(False).alias("copy"), F.col("_range").alias("r")), F.struct(F.lit(True).alias("copy"), F.col("_before").alias("r"))),
        ).otherwise(F.array(F.struct(F.lit(False).alias("copy"), F.col("_range").alias("r")))),
    )
    rows = copies.withColumn("_to", F.explode("_to")).select(*df.columns, F.col("_to.copy").alias("_copy"), F.col("_to.r").alias("_range"))
    return rows.repartition(partitions(spark), "_range")


def following(ranged: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The rows of dealt_by_range, each with next, a struct of columns of the row after it.

    Rows with one key follow each other by a hash of the first column.
    """
    order = Window.partitionBy("_range").orderBy("_copy", F.col(key).asc_nulls_first(), F.xxhash64(*columns[:1]))
    return ranged.withColumn("next", F.lead(F.struct(*columns)).over(order)).where("not _copy").drop("_copy", "_range")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited, kept, edited_kept, near_edited, near_next) of every row.

    The edited text has its last quarter of code points, rounded down, replaced by
    the first as many of the next document by ascending id (all of it, if it is
    shorter); after the last comes the first, and a lone document follows itself.
    kept and edited_kept are what winnowing keeps of both texts.

    Null texts are empty. Rows with one id follow each other by a hash of their
    text. Other columns are not read; no rows give no rows.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_minima(dealt_by_range(docs, "doc_id"), "text", "minima")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("quarter", F.floor(F.col("n_chars") / 4).cast("int"))
    # Windows within one of the two texts keep their minima: only what lies around the seam is winnowed again.
    reach = WINDOW + GRAM - 2
    rows = rows.withColumn("minima", F.array_distinct("minima")).withColumn("own", F.col("n_chars").cast("int") - F.col("quarter"))
    rows = rows.withColumn("same", F.greatest(F.col("own") - reach, F.lit(0)))
    rows = following(rows, "doc_id", ["text", "minima"])
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("own")), F.left(F.col("next.text"), F.col("quarter"))))
    rows = rows.withColumn("seam", F.expr(f"substring(edited, same + 1, own - same + {reach})"))
    rows = with_minima(rows, "seam", "around")
    head = begun(F.col("minima"), F.col("same"))
    short = (F.col("same") > 0) & (F.char_length("seam") <= reach)
    moved = F.when(short, F.array().cast("array<bigint>")).otherwise(F.transform("around", lambda x: x - F.col("same")))
    others = begun(F.col("next.minima"), F.least(F.col("quarter"), F.char_length("next.text")) - reach)
    others = F.transform(others, lambda x: x - F.col("own"))
    rows = rows.withColumn("edited_minima", F.array_distinct(F.concat(head, moved, others)))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        placed(F.col("minima")).alias("kept"),
        placed(F.col("edited_minima")).alias("edited_kept"),
        likeness(F.col("minima"), F.col("edited_minima")).alias("near_edited"),
        likeness(F.col("minima"), F.col("next.minima")).alias("near_next"),
    )

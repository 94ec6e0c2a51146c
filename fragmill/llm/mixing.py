"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling."""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, joined

#: The marginals count as met within this relative difference; rounds in a row without a gain after which targets count as in conflict.
TOLERANCE, PATIENCE = 1e-6, 20
#: A value of a dimension with less than one in so many tokens, and no target of its own, is raked together with the others like it.
VALUES = 256
REST = "(rest)"
NONE = "(none)"
TOPICS = 8


def with_tokens_and_topic(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with _tokens, its words or 1, and _topic: of eight hash classes of words, the one most of its words are in, the lowest of equals.

    Words are runs of anything but ASCII white space.
    """
    # Splitting at one plain character needs no pattern; what lies between two blanks is no word.
    pieces = F.split(F.translate(F.coalesce(F.col(text_col), F.lit("")), "\t\n\x0b\x0c\r", "     "), " ")
    rows = df.withColumn("_mix_class", F.transform(pieces, lambda w: F.when(w != "", F.pmod(F.hash(w), F.lit(TOPICS)))))
    rows = rows.withColumn("_mix_counts", F.array(*[_count(t) for t in range(TOPICS)]))
    words = F.aggregate("_mix_counts", F.lit(0), lambda n, c: n + c)
    topic = F.concat(F.lit("t"), (F.array_position("_mix_counts", F.array_max("_mix_counts")) - 1).cast("string"))
    # Not null by its type: a join on the topic then needs no filter, which would count all words once more.
    rows = rows.withColumn("_tokens", F.greatest(words, F.lit(1)).cast("double")).withColumn("_topic", F.coalesce(topic, F.lit("t0")))
    return rows.drop("_mix_class", "_mix_counts")


def _count(topic: int) -> Column:
    return F.size(F.filter("_mix_class", lambda c: c == topic))


def classes(cells: DataFrame, dim: str, named: Iterable[str] = ()) -> list[str]:
    """The values of a dimension that are raked on their own: those named, and those with a 256th of the tokens or more, of which there are 256 at most."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    large = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).where(F.col("t") * VALUES >= total)
    return sorted({*named, *(r[dim] for r in large.collect())})


def tempered(cells: DataFrame, dim: str, class_of: Column, power: float) -> dict[str, float]:
    """Target shares of the classes of a dimension: its values' token shares to a power below 1, so that rare values gain."""
    shares = cells.groupBy(dim).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("t"))
    return dict(shares.groupBy(class_of.alias("c")).agg(F.sum("t")).collect())


def reachable(goal: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The goals with none above the most that its class has; what that leaves goes to the other classes in proportion."""
    goal, full, total = goal.astype(float), np.zeros(len(goal), bool), min(goal.sum(), most.sum())
    while (over := ~full & (goal > most)).any():
        full |= over
        goal[full] = most[full]
        share = goal[~full] if goal[~full].sum() > 0 else most[~full]
        if share.sum() > 0:
            goal[~full] = share * (max(0.0, total - most[full].sum()) / share.sum())
    return goal


def _scaled(weight: np.ndarray, most: np.ndarray, goal: float) -> np.ndarray:
    """weight times the factor with which the weights, none counted above its most, add up to the goal."""
    if goal <= 0 or not len(weight):
        return np.zeros_like(weight)
    at = np.divide(most, weight, out=np.full(len(weight), math.inf), where=weight > 0)
    order = np.argsort(at, kind="stable")
    taken = np.concatenate([[0.0], np.cumsum(np.where(np.isinf(most), 0.0, most)[order])])[:-1]
    left = np.cumsum(weight[order][::-1])[::-1]
    factor = np.divide(goal - taken, left, out=np.full(len(left), math.inf), where=left > 0)
    first = np.flatnonzero(factor <= at[order])
    if not len(first) or math.isinf(factor[first[0]]):
        return np.maximum(weight, np.where(np.isinf(most), weight, most))
    return weight * factor[first[0]]


def raked(tokens: np.ndarray, codes: dict[str, np.ndarray], targets: dict[str, np.ndarray], budget: float | None = None) -> tuple[np.ndarray, float]:
    """Weights of cells, and how far the worst marginal is from its target, relatively.

    tokens has a number for each cell, codes its class in each dimension, and
    targets what each class is to have, in any unit; not-a-number keeps its share
    of the tokens. Weights add up to the budget and none is above its tokens; without
    a budget, they add up to the tokens and have no bound. A class whose target is
    above its tokens gets these, and the others of its dimension share the rest.

    Weights begin in proportion to the tokens and are scaled by a factor for each
    class of each dimension in turn, bounds included, until every marginal is its
    goal within TOLERANCE. Where goals conflict, rounds end when they no longer come
    nearer. The second value counts conflicts and targets above the tokens alike.
    """
    total = tokens.sum() if budget is None else min(budget, tokens.sum())
    most = np.full(len(tokens), math.inf) if budget is None else tokens.astype(float)
    weight, goals, short = tokens.astype(float), {}, 0.0
    for dim, target in targets.items():
        own = np.bincount(codes[dim], tokens, len(target))
        fixed = np.where(np.isnan(target) | (own == 0), 0.0, target)
        free = np.where(np.isnan(target), own, 0.0) * (total / max(tokens.sum(), 1e-300))
        wanted = fixed * ((total - free.sum()) / fixed.sum() if fixed.sum() else 0.0) + free
        goals[dim] = wanted
        if budget is not None:
            # Classes with targets share first; what they all cannot take goes to the others.
            held = reachable(np.where(fixed > 0, wanted, 0.0), np.where(fixed > 0, own, 0.0))
            left = np.where(free > 0, free, 0.0)
            goals[dim] = held + reachable(left * ((total - held.sum()) / left.sum() if left.sum() else 0.0), own)
        short = max(short, float(np.max(np.abs(goals[dim] - wanted) / np.maximum(wanted, TOLERANCE * total), initial=0.0, where=wanted > 0)) if total else 0.0)
    members = {d: [np.flatnonzero(c == k) for k in range(len(goals[d]))] for d, c in codes.items()}
    best, stalled, off = math.inf, 0, 0.0
    while total:
        for dim, groups in members.items():
            for own, goal in zip(groups, goals[dim]):
                weight[own] = _scaled(weight[own], most[own], goal)
        held = np.minimum(weight, most)
        off = max(float(np.max(np.abs(np.bincount(c, held, len(goals[d])) - goals[d]) / np.maximum(goals[d], TOLERANCE * total))) for d, c in codes.items())
        stalled = stalled + 1 if off > 0.999 * best else 0
        best = min(best, off)
        if off <= TOLERANCE or stalled >= PATIENCE:
            break
    return np.minimum(weight, most) if total else np.zeros(len(tokens)), max(off, short)


def _chances(cells: DataFrame, alone: dict, class_of: dict, given: dict, fraction: float, power: float) -> DataFrame:
    """(the class of each dimension, n, _probability) of the cells of classes, which have a bound whatever the corpus."""
    keys = {dim: f"{dim}_class" for dim in class_of}
    merged = cells.groupBy(*[c.alias(keys[dim]) for dim, c in class_of.items()]).agg(F.sum("tokens").alias("tokens"), F.sum("n").alias("n"))
    held = merged.toPandas().sort_values(list(keys.values()), ignore_index=True)
    codes, targets = {}, {}
    for dim, values in alone.items():
        values = [*values, REST]
        wanted = given[dim] if given[dim] is not None else tempered(cells, dim, class_of[dim], power)
        codes[dim] = held[keys[dim]].map({v: i for i, v in enumerate(values)}).to_numpy(int)
        targets[dim] = np.array([wanted.get(v, math.nan) for v in values], float)
    tokens = held["tokens"].to_numpy(float)
    weight, off = raked(tokens, codes, targets, fraction * tokens.sum())
    if off > TOLERANCE:
        warnings.warn(f"the targets conflict or are above what there is: the worst marginal is {off:.2%} off", stacklevel=3)
    held["_probability"] = np.minimum(1.0, weight / np.maximum(tokens, 1e-300))
    columns = ", ".join(f"{k} string" for k in keys.values())
    return cells.sparkSession.createDataFrame(held[[*keys.values(), "n", "_probability"]], f"{columns}, n long, _probability double")


def mixed(
    df: DataFrame,
    fraction: float = 0.5,
    power: float = 0.7,
    targets: dict[str, dict[str, float]] | None = None,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_col: str | None = None,
) -> DataFrame:
    """The rows and columns of df with _source, _lang, _topic, _tokens, _probability and _picked.

    Token weights of the cells (source, language, topic) are raked to target
    shares: those given by value for a dimension ("source", "lang", "topic"), else
    its own shares to a power. Weights add up to the wanted fraction of all tokens,
    and none is above its cell's tokens, so a document's probability, its cell's
    weight over its tokens, is calibrated: expected tokens are the targets. A
    document is picked if a hash of its id is below its probability, so that one
    seed always picks the same. A warning names the worst marginal where targets
    conflict or a value has too few tokens; it is then taken whole.

    Values with less than a 256th of all tokens and no target of their own are
    raked together, as small classes are in raking: they keep their shares of each
    other. So the classes are few by proof, and so is what the driver rakes.

    Topics are those of topic_col; without one, classes of words stand for them.
    Null sources, languages and topics are the value "(none)"; a null text has one
    token. Rows with one id are picked alike if their cell is the same; so are null
    ids. Other columns stay; those with the names above are replaced. No rows give
    no rows.
    """
    dims = ["_source", "_lang", "_topic"]
    given = {dim: (targets or {}).get(dim[1:]) for dim in dims}
    made = [*dims, "_tokens", "_probability", "_picked"]
    kept = [c for c in df.columns if c.lower() not in made]
    words = with_tokens_and_topic(df.select(F.col(f"`{text_col}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")))
    value = lambda c: F.coalesce(F.col(f"_row.`{c}`").cast("string"), F.lit(NONE))
    rows = words.withColumn("_source", value(source_col)).withColumn("_lang", value(lang_col))
    if topic_col:
        rows = rows.withColumn("_topic", value(topic_col))
    cells = cut(rows.groupBy(*dims).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("n")))
    alone = {dim: classes(cells, dim, given[dim] or ()) for dim in dims}
    class_of = {dim: F.when(F.col(dim).isin(alone[dim]), F.col(dim)).otherwise(F.lit(REST)) for dim in dims}
    chances = cut(_chances(cells, alone, class_of, given, fraction, power))
    keys = [f"{dim}_class" for dim in dims]
    rows = rows.withColumns(dict(zip(keys, class_of.values())))
    found = joined(rows, chances, keys)
    draw = (F.xxhash64(F.lit(seed), F.col(f"_row.`{id_col}`")).bitwiseAND((1 << 53) - 1)) / float(1 << 53)
    found = found.withColumn("_picked", draw < F.col("_probability"))
    return found.select(*[F.col(f"_row.`{c}`") for c in kept], *made)

"""Dialogues, their turns and the validation of answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragmill.operators.ranking import numbered_within

CONCLUSIONS = (-1, 0, 1)


def turn_counts(users: DataFrame, dialogues: DataFrame, turns: DataFrame) -> DataFrame:
    """(user_id, turn_count) of all users, zero where none: deleted dialogues go before the join, so their users stay."""
    live = dialogues.where(~F.col("is_deleted"))
    rows = users.join(live, "user_id", "left").join(turns, "dialogue_id", "left")
    return rows.groupBy("user_id").agg(F.count("turn_id").alias("turn_count"))


def turn_counts_where(users: DataFrame, dialogues: DataFrame, turns: DataFrame) -> DataFrame:
    """The same with the filter after the join: users without a live dialogue go."""
    rows = users.join(dialogues, "user_id", "left").where(~F.col("is_deleted")).join(turns, "dialogue_id", "left")
    return rows.groupBy("user_id").agg(F.count("turn_id").alias("turn_count"))


def nested(parents: DataFrame, children: DataFrame, key: str, order: str, fields: list[str], out: str) -> DataFrame:
    """Parents with out, their children as an array of structs in order; empty where there is none.

    Children are aggregated before the join: one row for each parent crosses it.
    """
    listed = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias(out))
    return parents.join(listed, key, "left").withColumn(out, F.coalesce(out, F.array().cast(listed.schema[out].dataType)))


def flagged(rows: DataFrame, known: DataFrame, keys: list[str], flag: str, value: str) -> DataFrame:
    """rows with value of the known row with their keys, and whether there is one."""
    return rows.join(known.select(*keys, value), keys, "left").withColumn(flag, F.col(value).isNotNull())


def paired(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, question, answer): each user turn with the assistant's turn that follows it at once, if it does."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    ahead = turns.withColumn("_role", F.lead("role").over(order)).withColumn("_text", F.lead("text").over(order))
    answer = F.when(F.col("_role") == "assistant", F.col("_text"))
    return ahead.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"), answer.alias("answer"))


def matching(
    status: str | None = None,
    conclusion: int | None = None,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    keyword: str | None = None,
    columns: tuple[str, ...] = ("question", "answer", "comment"),
) -> list[Column]:
    """The conditions that a review query sets; all hold at once, and the keyword in any of the columns, in any case."""
    if conclusion is not None and conclusion not in CONCLUSIONS:
        raise ValueError(f"conclusion must be one of {CONCLUSIONS}")
    if since and until and since > until:
        raise ValueError("since is after until")
    found = []
    if status is not None:
        found.append(F.col("status") == status)
    if conclusion is not None:
        found.append(F.col("judge_conclusion") == conclusion)
    if since is not None:
        found.append(F.col("updated_at") >= F.lit(since))
    if until is not None:
        found.append(F.col("updated_at") <= F.lit(until))
    if keyword:
        some = F.lit(False)
        for c in columns:
            some = some | F.coalesce(F.col(c).ilike(f"%{keyword}%"), F.lit(False))
        found.append(some)
    return found


def filtered(rows: DataFrame, conditions: list[Column]) -> DataFrame:
    for condition in conditions:
        rows = rows.where(condition)
    return rows


def reviewed(rows: DataFrame, done: str) -> DataFrame:
    """status becomes done, unless conclusion, content and attachments are all missing."""
    missing = F.col("judge_conclusion").isNull() & F.col("judge_content").isNull() & (F.coalesce(F.size("attachments"), F.lit(0)) <= 0)
    return rows.withColumn("status", F.when(missing, F.col("status")).otherwise(F.lit(done)))


def unique_names(rows: DataFrame, name: str, order: str, out: str) -> DataFrame:
    """out: the name, with 1, 2, ... behind it from its second time on, in order."""
    n = F.col("_nth") - 1
    each = numbered_within(rows, [name], [order], "_nth")
    return each.withColumn(out, F.when(n == 0, F.col(name)).otherwise(F.concat(F.col(name), n.cast("string")))).drop("_nth")


def next_number(rows: DataFrame, column: str, least: int) -> DataFrame:
    """One row: the number after the largest, and at least the given one."""
    return rows.agg(F.greatest(F.lit(least).cast("bigint"), F.coalesce(F.max(F.col(column).cast("bigint")), F.lit(0)) + 1).alias("next_number"))


def exploded(records: DataFrame, key: str, children: str) -> DataFrame:
    """A row for each child of nested records, with its number from 1 and its fields; records without children give none."""
    each = records.select(key, F.posexplode(children).alias("_at", "_child"))
    return each.select(key, (F.col("_at") + 1).alias("number"), "_child.*")


def appended(old: DataFrame, new: DataFrame, unique: list[str]) -> tuple[DataFrame, DataFrame]:
    """(all rows, refused rows): new rows whose unique columns stand in old, or earlier in new by all their columns, are refused."""
    n = F.row_number().over(Window.partitionBy(*unique).orderBy(*[c for c in new.columns if c not in unique] or unique))
    ranked = new.withColumn("_n", n).join(old.select(*unique).distinct().withColumn("_old", F.lit(True)), unique, "left")
    fresh = F.col("_old").isNull() & (F.col("_n") == 1)
    return old.unionByName(ranked.where(fresh).select(old.columns)), ranked.where(~fresh).select(new.columns)


def updated(rows: DataFrame, chosen: Column, **values: Column) -> DataFrame:
    """rows with new values of columns where a condition holds."""
    return rows.withColumns({name: F.when(chosen, value).otherwise(F.col(name)) for name, value in values.items()})


def removed(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """rows without those whose keys are in gone."""
    return rows.join(gone.select(*keys).distinct(), keys, "left_anti")


def unnested(records: DataFrame, key: str, children: list[str], child: str) -> DataFrame:
    """(key, turn_count, kind, number and the fields of child) of the arrays of a record, read once; turn_count is the size of the first array."""

    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda x, i: F.struct(F.lit(kind).alias("kind"), (i + 1).alias("number"), x[child].alias(child)))

    return records.select(key, F.size(children[0]).alias("turn_count"), F.inline(F.flatten(F.array(*map(tagged, children)))))

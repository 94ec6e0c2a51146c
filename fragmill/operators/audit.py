"""Audit records of requests: who asked, and what must not be logged."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragmill.operators.ranking import numbered

# Keys whose values are masked, and the mask.
SENSITIVE_KEYS = ["password", "passwd", "token", "access_token", "refresh_token", "authorization", "secret", "api_key"]
MASK = "***"
#: Where a path names a user.
USER_PATH = r"(?i)(?:^|/)users/([^/?#]+)(?:/|$)"
# Names of a user's id in headers and in fields, in the order they are looked for, and its length at most.
HEADERS = ["x-user-id", "x-authenticated-user-id"]
FIELDS = ["user_id", "userId"]
LONGEST_ID = 256


def _hide(record) -> None:
    """Masks the values of sensitive keys in place; a stack, so that no depth is too deep."""
    todo = [record]
    while todo:
        at = todo.pop()
        for key, value in at.items() if isinstance(at, dict) else enumerate(at) if isinstance(at, list) else ():
            if isinstance(key, str) and key.lower() in SENSITIVE_KEYS:
                at[key] = MASK
            elif isinstance(value, (dict, list)):
                todo.append(value)


def _finite(number: str) -> float:
    value = float(number)
    if math.isinf(value):
        raise OverflowError(number)
    return value


@F.pandas_udf(T.StringType())
def _masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def one(text: str) -> str:
        try:
            record = json.loads(text, parse_float=_finite)
            _hide(record)
            return json.dumps(record, ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return text
        except (RecursionError, OverflowError):
            return MASK

    for texts in batches:
        yield texts.map(one, na_action="ignore")


def masked(text: Column) -> Column:
    """JSON text with the whole value of each sensitive key masked, whatever it is and at any depth.

    Keys count in any case, but only as a whole. What is no JSON stays as it is, and
    so does text in which no such key can be; nulls stay null. A record that is
    nested too deep to be read, or holds a number beyond a double, becomes the mask.
    """
    maybe = text.rlike("(?i)" + "|".join(SENSITIVE_KEYS)) | text.contains("\\u")
    return F.when(maybe, _masked(text)).otherwise(text)


def truncated(text: Column, length: int, mark: str = "") -> Column:
    """Text of at most so many characters; what is cut shows the mark."""
    return F.when(F.char_length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit(mark))).otherwise(text)


def _parameters(text: Column) -> Column:
    """array<struct<k, v>> of an encoded query or form, decoded."""
    part = lambda p: F.split(p, "=", 2)
    decoded = lambda x: F.coalesce(F.try_url_decode(x), x)
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "&"), lambda p: F.struct(decoded(part(p)[0]).alias("k"), decoded(F.coalesce(F.get(part(p), F.lit(1)), F.lit(""))).alias("v"))
    )


def _scalar(value: Column) -> Column:
    """A text without blanks around it, of LONGEST_ID characters at most; null if that leaves nothing."""
    return F.nullif(F.left(F.regexp_replace(value, r"^\s+|\s+$", ""), F.lit(LONGEST_ID)), F.lit(""))


def _let(value: Column, body) -> Column:
    """What body makes of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _field(record: Column, name: str) -> Column:
    """A text, whole number or truth value of a JSON object as text; null for all else."""

    def told(value: Column) -> Column:
        kind, text = F.schema_of_variant(value), value.cast("string")
        return F.when(kind.rlike(r"^(STRING|BIGINT|DECIMAL\(\d+,0\))$"), text).when(kind == "BOOLEAN", F.initcap(text))

    return _let(F.try_variant_get(record, f"$.{name}", "variant"), told)


def identity(headers: Column, query: Column, path: Column, body: Column) -> Column:
    """struct<user_id, user_id_source>: from a header, else the query, the path, or a body that the content type says to be JSON or a form; nulls if none has it.

    Header names count in any case. Of a name that a query repeats the last value
    counts, in a form the first that is not blank. Query, form and JSON are each read
    once, and the ways to an id are one array of which the first that is left counts.
    """
    heads = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))
    named = lambda pairs, name: F.transform(F.filter(pairs, lambda p: p["k"] == name), lambda p: p["v"])
    none = F.struct(F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("string").alias("user_id_source"))

    def read(x: Column) -> Column:
        kind = F.lower(F.trim(F.substring_index(F.coalesce(F.get(named(x["heads"], "content-type"), F.lit(0)), F.lit("")), ";", 1)))
        record = F.try_parse_json(F.when(kind == "application/json", body))
        form = _parameters(F.when(kind == "application/x-www-form-urlencoded", body))
        return F.struct(x["heads"].alias("heads"), _parameters(query).alias("query"), record.alias("record"), form.alias("form"))

    def found(x: Column) -> Column:
        ways = [(F.get(named(x["heads"], name), F.lit(0)), f"header:{name}") for name in HEADERS]
        ways += [(F.try_element_at(named(x["query"], name), F.lit(-1)), f"query:{name}") for name in FIELDS]
        ways += [(F.regexp_extract(path, USER_PATH, 1), "path")]
        ways += [(_field(x["record"], name), f"json:{name}") for name in FIELDS]
        ways += [(F.get(F.filter(named(x["form"], name), lambda v: v != ""), F.lit(0)), f"form:{name}") for name in FIELDS]
        each = F.array(*(F.struct(value.cast("string").alias("v"), F.lit(source).alias("s")) for value, source in ways))
        each = F.transform(each, lambda w: F.struct(_scalar(w["v"]).alias("user_id"), w["s"].alias("user_id_source")))
        return F.get(F.filter(each, lambda w: w["user_id"].isNotNull()), F.lit(0))

    return F.coalesce(_let(_let(F.struct(heads.alias("heads")), read), found), none)


def requests_by(records: DataFrame, time: str, key: str, span: str) -> DataFrame:
    """(start, key, n): records of each key in each span of time."""
    window = F.window(F.col(time).cast("timestamp"), span)
    return records.groupBy(window.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def path_requests(requests: DataFrame, order: list[str], start: int = 0) -> tuple[DataFrame, DataFrame]:
    """(recorded, refused) of requests for paths (source_type, aim_type, max_jump_num, max_path_num and more).

    A request needs both types and limits above 0; those that have them get an id
    after start in an order without ties, the others their error.
    """
    blank = (F.coalesce("source_type", F.lit("")) == "") | (F.coalesce("aim_type", F.lit("")) == "")
    low = ~F.coalesce((F.col("max_jump_num") > 0) & (F.col("max_path_num") > 0), F.lit(False))
    error = F.when(blank, "source_type and aim_type cannot be empty").when(low, "max_jump_num and max_path_num must be greater than 0")
    judged = requests.withColumn("error", error)
    recorded = numbered(judged.where("error is null").drop("error"), order, "_n")
    return recorded.withColumn("id", F.col("_n") + start).drop("_n"), judged.where("error is not null")

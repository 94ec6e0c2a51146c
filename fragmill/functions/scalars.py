"""Scalar functions of the warehouse and its reports."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def split_trimmed(text: Column, by: str = ";") -> Column:
    """The non-blank parts of a text, trimmed; by is taken as it is."""
    literal = "".join(f"\\{c}" if not c.isalnum() and c != " " else c for c in by)
    return F.filter(F.transform(F.split(text, literal), lambda x: F.trim(x)), lambda x: x != "")


def path_molecule(path: Column) -> Column:
    """The molecule that a partition folder in a path names; null if none does."""
    return F.nullif(F.regexp_extract(path, r"molecule_id=([^\\/]+)", 1), F.lit(""))


def build_of(path: Column) -> Column:
    """The last folder of a path that begins with build_."""
    return F.element_at(F.filter(F.split(path, r"[\\/]"), lambda p: p.startswith("build_")), -1)


def mask_hex(bits: Column) -> Column:
    """The hexadecimal mask of an array of bit numbers, of any width, without leading zeros; 0 if there are none."""
    set_bits = F.array_distinct(bits)
    digit = lambda i: F.aggregate(
        F.filter(set_bits, lambda b: F.floor(b / 4) == i), F.lit(0), lambda n, b: n + F.pow(F.lit(2), b % 4).cast("int")
    )
    places = F.reverse(F.sequence(F.lit(0).cast("bigint"), F.floor(F.coalesce(F.array_max(set_bits), F.lit(0)) / 4)))
    return F.array_join(F.transform(places, lambda i: F.lower(F.hex(digit(i)))), "")


def is_phone(text: Column) -> Column:
    """Whether a text is a mobile number of eleven digits."""
    return text.rlike(r"^1[3-9]\d{9}$")


def quoted(name: str) -> str:
    """An identifier in back-ticks."""
    return "`" + name.replace("`", "``") + "`"


def json_list(text: Column) -> Column:
    """A JSON list of texts; an empty one if it is null, blank or no list."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def first_field(json: Column, *names: str) -> Column:
    """The first of the named fields that JSON has."""
    return F.coalesce(*[F.get_json_object(json, f"$.{n}") for n in names])


def zero_as_null(number: Column) -> Column:
    return F.nullif(number, F.lit(0))


def column_at(columns: list[str], place: str) -> str:
    """A column by number from 1, else by header in any case, else by spreadsheet letters."""
    by_name = {c.lower(): c for c in columns}
    if place.isdigit():
        at = int(place)
    elif place.lower() in by_name:
        return by_name[place.lower()]
    elif place.isalpha() and place.isascii():
        at = 0
        for letter in place.upper():
            at = at * 26 + ord(letter) - ord("A") + 1
    else:
        raise ValueError(f"no column {place!r}")
    if not 1 <= at <= len(columns):
        raise ValueError(f"no column {place!r} among {len(columns)}")
    return columns[at - 1]


def blake2b(bits: int):
    """A function of text to BLAKE2b hex of so many bits, in Arrow batches: Spark has none of its own."""

    @F.pandas_udf("string")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: hashlib.blake2b(t.encode(), digest_size=bits // 8).hexdigest(), na_action="ignore")

    return hashed

"""Format-preserving pseudonyms for numbers, dates and addresses in text, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

ROUNDS = 8
#: Days from 1900-01-01 that are permuted: 271 x 270, up to 2100-05-01.
_DAYS = (271, 270)
#: Rounds in which a date is permuted until its day is no month; each leaves four in ten.
_WALKS = 24

#: Countries by the length of their IBANs.
_IBANS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|CR|HR|LI|LV",
    22: "BG|BH|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE",
    31: "MT|SC", 32: "LC", 33: "RU",
}


def _own_length(size: int, countries: str) -> str:
    """IBANs of this many characters, in groups of four or none."""
    groups, rest = divmod(size - 4, 4)
    return rf"(?:{countries})\d{{2}}(?: ?[0-9A-Z]{{4}}){{{groups}}}" + (f" ?[0-9A-Z]{{{rest}}}" if rest else "")


_IBAN = "|".join([*(_own_length(*i) for i in _IBANS.items()), r"[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,4})?"])

#: What may be private, longest kinds first; each match is validated before it is replaced.
KINDS = {
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,18}",
    "date": r"(?<![\d.])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d]|[./-]\d)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "phone": r"(?<![\d+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)|(?<![\w+])\+\d{8,15}(?!\d)|(?<![\d.-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": rf"(?<![0-9A-Za-z])(?:{_IBAN})(?![0-9A-Za-z])",
    "account": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
}
_ANY = "|".join(KINDS.values())
#: Matches whose places are counted together.
_BLOCK = 128


def kind_of(match: Column) -> Column:
    """The kind of a match, or null if its numbers are not valid."""
    whole = lambda kind: match.rlike(f"^(?:{KINDS[kind]})$")
    octets = F.forall(F.split(match, r"\."), lambda o: o.cast("int") <= 255)
    return (
        F.when(whole("secret"), F.when(match.rlike("[A-Fa-f]") & match.rlike("[0-9]"), F.lit("secret")))
        .when(whole("email"), F.lit("email"))
        .when(whole("date"), F.when(_day(match).between(0, _DAYS[0] * _DAYS[1] - 1), F.lit("date")))
        .when(whole("ip"), F.when(octets, F.lit("ip")))
        .when(whole("phone"), F.lit("phone"))
        .when(whole("ssn"), F.when(~match.rlike("^(000|666|9)|-00-|-0000$"), F.lit("ssn")))
        .when(whole("iban"), F.when(_iban_remainder(match) == 1, F.lit("iban")))
        .when(whole("account"), F.when(_is_card(F.regexp_replace(match, "[ -]", "")), F.lit("account")))
    )


def _format(match: Column) -> Column:
    return F.when(match.contains("-"), F.lit("yyyy-MM-dd")).when(match.contains("/"), F.lit("dd/MM/yyyy")).otherwise(F.lit("dd.MM.yyyy"))


def _day(match: Column) -> Column:
    """Days since 1900-01-01 of a date that the calendar has; else null."""
    stamp = F.coalesce(*(F.try_to_timestamp(match, F.lit(f)) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy", "MM/dd/yyyy")))
    return F.datediff(stamp.cast("date"), F.lit("1900-01-01").cast("date"))


def _iban_remainder(match: Column) -> Column:
    """The number of an IBAN, letters as 10 to 35, modulo 97."""
    bare = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 99), F.substring(bare, 1, 4))
    digits = F.transform(
        F.split(turned, ""),
        lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(F.lit(0)),
    )
    return F.aggregate(digits, F.lit(0).cast("int"), lambda r, d: ((r * F.when(d < 10, 10).otherwise(100) + d) % 97).cast("int"))


def _noise(key: str, tag: Column, turn: Column, other: Column) -> Column:
    """128 keyed hex digits that depend on what a round does not change."""
    return F.sha2(F.concat_ws("|", F.lit(key), tag, turn.cast("string"), other), 512)


def _number(hexits: Column, size: Column) -> Column:
    return F.conv(F.substring(hexits, 1, 12), 16, 10).cast("bigint") % size


def _pair(key: str, tag: str, a: Column, b: Column, size_a: int, size_b: int) -> Column:
    """A keyed permutation of the pairs (a, b) below their sizes: each round shifts one by a function of the other."""
    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))

    def turn(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        moved_a = (s["a"] + _number(_noise(key, F.lit(tag), r, s["b"].cast("string")), F.lit(size_a))) % size_a
        moved_b = (s["b"] + _number(_noise(key, F.lit(tag), r, s["a"].cast("string")), F.lit(size_b))) % size_b
        return F.struct(F.when(even, moved_a).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(moved_b).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _shifted(part: Column, hexits: Column, hexadecimal: Column) -> Column:
    """Each digit and letter moved within its own alphabet, the rest as it is; no half that is permuted is longer than 32.

    hexadecimal is "lower" or "upper" where digits and letters are one alphabet of
    sixteen, "mixed" where letters of either case stay among the first six, else ''.
    """

    def moved(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(hexits, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        at = lambda first, size: F.char(F.lit(first) + (F.ascii(c) - first + by) % size)
        sixteen = lambda digits: F.substring(F.lit(digits), (F.instr(F.lit(digits), c) - 1 + by) % 16 + 1, F.lit(1))
        return (
            F.when((hexadecimal == "lower") & c.rlike("[0-9a-f]"), sixteen("0123456789abcdef"))
            .when((hexadecimal == "upper") & c.rlike("[0-9A-F]"), sixteen("0123456789ABCDEF"))
            .when((hexadecimal == "mixed") & c.rlike("[a-f]"), at(97, 6))
            .when((hexadecimal == "mixed") & c.rlike("[A-F]"), at(65, 6))
            .when(c.rlike("[0-9]"), at(48, 10))
            .when(c.rlike("[a-z]"), at(97, 26))
            .when(c.rlike("[A-Z]"), at(65, 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(part, ""), moved), "")


def _letters(key: str, tag: Column, text: Column, hexadecimal: Column) -> Column:
    """A keyed permutation of the texts of one format: the halves shift each other in turn."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substring(text, half + 1, F.length(text)).alias("b"))

    def turn(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        moved_a = _shifted(s["a"], _noise(key, tag, r, s["b"]), hexadecimal)
        moved_b = _shifted(s["b"], _noise(key, tag, r, s["a"]), hexadecimal)
        return F.struct(F.when(even, moved_a).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(moved_b).alias("b"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
    return F.concat(done["a"], done["b"])


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits, modulo 10, as if a check digit followed."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), worth), F.lit(0), lambda s, w: s + w) % 10


def _is_card(digits: Column) -> Column:
    """Whether the last digit is the check digit of those before it."""
    return (_luhn(F.substring(digits, F.lit(1), F.length(digits) - 1)) + F.right(digits, F.lit(1)).cast("int")) % 10 == 0


def _phone(key: str, match: Column) -> Column:
    """The digits alone are permuted, so that one number is the same in every way of writing it."""
    return _filled(match, _letters(key, F.lit("phone"), F.regexp_replace(match, "[^0-9]", ""), F.lit("")))


def _ssn(key: str, match: Column) -> Column:
    """A permutation of the valid numbers: area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    area, group, serial = (F.substring(match, i, n).cast("int") for i, n in ((1, 3), (5, 2), (8, 4)))
    to = _pair(key, "ssn", area - 1 - (area > 666).cast("int"), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
    digits = lambda n, size: F.lpad(n.cast("string"), size, "0")
    return F.concat_ws(
        "-", digits(to["a"] + 1 + (to["a"] >= 665).cast("int"), 3), digits(F.floor(to["b"] / 9999) + 1, 2), digits(to["b"] % 9999 + 1, 4)
    )


def _account(key: str, match: Column) -> Column:
    """Digits before the last are permuted; the last follows as their check digit."""
    digits = F.regexp_replace(match, "[ -]", "")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    new = _letters(key, F.lit("account"), body, F.lit(""))
    return _filled(match, F.concat(new, ((10 - _luhn(new)) % 10).cast("string")))


def _card(match: Column) -> Column:
    """The longest card number with a right check digit that whole groups of a match make up; else null."""
    groups = F.split(match, "(?<=[ -])")

    def made(i: Column) -> Column:
        return F.transform(F.sequence(i, F.size(groups)), lambda j: F.struct((-i).alias("at"), F.regexp_replace(F.array_join(F.slice(groups, i, j - i + 1), ""), "[ -]+$", "").alias("was")))

    spans = F.transform(
        F.flatten(F.transform(F.sequence(F.lit(1), F.size(groups)), made)),
        lambda s: F.struct(F.regexp_replace(s["was"], "[ -]", "").alias("digits"), s["at"].alias("at"), s["was"].alias("was")),
    )
    cards = F.filter(spans, lambda s: s["digits"].rlike("^[2-6][0-9]{12,15}([0-9]{3})?$") & F.length(s["digits"]).isin(13, 14, 15, 16, 19) & _is_card(s["digits"]))
    # Nineteen digits count last unless they are grouped as one number.
    odd = lambda s: (F.length(s["digits"]) == 19) & ~s["was"].rlike("^(?:[0-9]{19}|(?:[0-9]{4}[ -]){4}[0-9]{3})$")
    return F.array_max(F.transform(cards, lambda s: F.struct(F.when(odd(s), 0).otherwise(F.length(s["digits"])).alias("n"), s["at"].alias("at"), s["was"].alias("was"))))["was"]


def _within(gap: Column, match: Column) -> Column:
    """array<struct<gap, was>>: what is to be judged of a match, each with the text before it; the last may be empty."""
    part = lambda g, w: F.struct(g.alias("gap"), w.alias("was"))

    def carded(gap: Column, match: Column, card: Column, other: Column) -> Column:
        at = F.instr(match, card)
        before = part(F.concat(gap, F.substring(match, F.lit(1), at - 1)), card)
        after = part(F.substring(match, at + F.length(card), F.length(match)), F.lit(""))
        return F.when(card.isNotNull(), F.array(before, after)).otherwise(F.array(other))

    # In what is no IBAN only numbers with a right check digit count.
    account = KINDS["account"]
    inner = F.zip_with(
        F.split(match, account, -1),
        F.regexp_extract_all(match, F.lit(f"({account})"), F.lit(1)),
        lambda g, w: part(g, F.coalesce(w, F.lit(""))),
    )
    before = lambda p, i: F.concat(F.when(i == 0, gap).otherwise(F.lit("")), p["gap"])
    inner = F.flatten(
        F.transform(inner, lambda p, i: carded(before(p, i), p["was"], _card(p["was"]), part(F.concat(before(p, i), p["was"]), F.lit(""))))
    )
    grouped = match.rlike("^[0-9]+[ -]") & match.rlike(f"^(?:{account})$")
    no_iban = match.rlike("^[A-Z]{2}[0-9]{2}") & match.rlike(f"^(?:{KINDS['iban']})$")
    return F.when(no_iban & (_iban_remainder(match) != 1), inner).otherwise(carded(gap, match, F.when(grouped, _card(match)), part(gap, match)))


def _filled(match: Column, digits: Column) -> Column:
    """The match with its digits replaced in order."""

    def put(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(match, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(digits, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(match, ""), put), "")


def _month_first(match: Column) -> Column:
    """Whether a date has its month before its day: MM/dd/yyyy where dd/MM/yyyy is no date."""
    return match.rlike("^[0-9]{2}/(1[3-9]|[23][0-9])/")


def _date(key: str, match: Column) -> Column:
    """The permuted date; those with the month first are permuted until they can be read so only, so they stay apart from the rest."""

    def moved(day: Column) -> Column:
        to = _pair(key, "date", F.floor(day / _DAYS[1]), day % _DAYS[1], *_DAYS)
        return (to["a"] * _DAYS[1] + to["b"]).cast("int")

    at = lambda day: F.date_add(F.lit("1900-01-01").cast("date"), day)
    again = F.aggregate(
        F.sequence(F.lit(1), F.lit(_WALKS)), moved(_day(match)), lambda day, i: F.when(F.dayofmonth(at(day)) > 12, day).otherwise(moved(day))
    )
    return F.date_format(at(F.when(_month_first(match), again).otherwise(moved(_day(match)))), "yyyy-MM-dd")


def _dated(key: str, match: Column) -> Column:
    """A date in the format of the match."""
    made = _date(key, match)
    year, month, day = F.substring(made, 1, 4), F.substring(made, 6, 2), F.substring(made, 9, 2)
    return (
        F.when(match.contains("-"), made)
        .when(_month_first(match), F.concat_ws("/", month, day, year))
        .when(match.contains("/"), F.concat_ws("/", day, month, year))
        .otherwise(F.concat_ws(".", day, month, year))
    )


def _address(key: str, match: Column) -> Column:
    o = F.transform(F.split(match, r"\."), lambda x: x.cast("int"))
    to = _pair(key, "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
    return F.concat_ws(".", *(x.cast("string") for x in (F.floor(to["a"] / 256), to["a"] % 256, F.floor(to["b"] / 256), to["b"] % 256)))


def _iban(key: str, match: Column) -> Column:
    """Country and grouping stay; the account is permuted and the check digits follow."""
    bare = F.replace(match, F.lit(" "), F.lit(""))
    new = _letters(key, F.concat(F.lit("iban"), F.left(bare, F.lit(2))), F.substring(bare, 5, 99), F.lit(""))
    blank = F.concat(F.left(bare, F.lit(2)), F.lit("00"), new)
    check = F.lpad((F.lit(98) - _iban_remainder(blank)).cast("string"), 2, "0")
    made = F.concat(F.left(bare, F.lit(2)), check, new)

    def put(c: Column, i: Column) -> Column:
        place = F.length(F.replace(F.substring(match, F.lit(1), i + 1), F.lit(" "), F.lit("")))
        return F.when(c == " ", c).otherwise(F.substring(made, place, F.lit(1)))

    return F.array_join(F.transform(F.split(match, ""), put), "")


def pseudonym(match: Column, kind: Column, key: str) -> Column:
    """What stands for a match of a kind; its own text if the kind is null."""
    user, host = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    return (
        F.when(kind.isNull(), match)
        .when(kind == "account", _account(key, match))
        .when(kind == "date", _dated(key, match))
        .when(kind == "ip", _address(key, match))
        .when(kind == "iban", _iban(key, match))
        .when(kind == "phone", _phone(key, match))
        .when(kind == "ssn", _ssn(key, match))
        .when(kind == "email", F.concat(_letters(key, kind, user, F.lit("")), F.lit("@"), host))
        .when(kind == "secret", _letters(key, kind, match, F.when(match == F.lower(match), "lower").when(match == F.upper(match), "upper").otherwise("mixed")))
        .otherwise(_letters(key, kind, match, F.lit("")))
    )


def pseudonymised(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The rows and columns of df with their text pseudonymised, and found, array<struct<kind, at, was, now>>.

    Numbers and dates that are valid (accounts of 13 to 19 digits with a right
    check digit, phones, IPv4 addresses, calendar dates, social security numbers,
    IBANs with right check digits), the users of e-mail addresses and long
    hexadecimal secrets are replaced by a keyed Feistel permutation within their
    format: length, punctuation, letter case and validity stay, different values
    stay different, and equal values are equal in every document, accounts and
    phones also if they are grouped otherwise. An address stays four numbers, but
    these may be longer or shorter. Dates before 1900-01-01 or after 2100-05-01 stay
    as they are, as do values that are not valid. Users of e-mail addresses that
    differ in letter case differ, and so are not linked. at counts code points from
    0, in the text as it was.

    A null text stays null and an empty one empty, both with nothing found; text
    of any length is read whole. A column named found is replaced; no other is
    touched. No rows give no rows.
    """
    quiet = F.array().cast("array<struct<kind:string,at:int,was:string,now:string>>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits, gaps, parts, kinds, wide, sums, ends = fresh(df.columns, "hits", "gaps", "parts", "kinds", "wide", "sums", "ends")
    # A cheap test keeps the patterns off most texts: each kind has a digit or an @.
    maybe = text.rlike("[0-9@]")
    rows = df.drop("found").withColumn(hits, F.when(maybe, F.regexp_extract_all(text, F.lit(f"({_ANY})"), F.lit(1))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn(gaps, F.when(F.size(hits) > 0, F.split(text, _ANY, -1)).otherwise(F.array(text)))
    last = lambda g: F.array(F.struct(g.alias("gap"), F.lit("").alias("was")))
    rows = rows.withColumn(
        parts, F.when(F.size(hits) > 0, F.flatten(F.zip_with(gaps, hits, lambda g, h: F.when(h.isNull(), last(g)).otherwise(_within(g, h)))))
    )
    split = F.col(parts).isNotNull()
    rows = rows.withColumn(gaps, F.when(split, F.col(f"{parts}.gap")).otherwise(F.col(gaps)))
    rows = rows.withColumn(hits, F.when(split, F.col(f"{parts}.was")).otherwise(F.col(hits)))
    rows = rows.withColumn(kinds, F.transform(hits, lambda m: F.struct(m.alias("was"), kind_of(m).alias("kind"))))
    rows = rows.withColumn(
        kinds, F.transform(kinds, lambda k: F.struct(k["was"].alias("was"), k["kind"].alias("kind"), pseudonym(k["was"], k["kind"], key).alias("now")))
    )
    # Where each match begins: what stands before its block of matches, and before it in the block.
    total = lambda x: F.aggregate(x, F.lit(0), lambda n, w: n + w)
    rows = rows.withColumn(wide, F.zip_with(gaps, hits, lambda g, h: F.char_length(g) + F.coalesce(F.char_length(h), F.lit(0))))
    rows = rows.withColumn(
        sums, F.when(F.size(kinds) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(wide) - 1) / _BLOCK)), lambda b: total(F.slice(F.col(wide), b.cast("int") * _BLOCK + 1, F.lit(_BLOCK)))))
    )
    rows = rows.withColumn(sums, F.transform(sums, lambda _, b: total(F.slice(F.col(sums), F.lit(1), b))))
    before = lambda i: F.get(F.col(sums), F.floor(i / _BLOCK).cast("int")) + total(F.slice(F.col(wide), i - i % _BLOCK + 1, i % _BLOCK))
    rows = rows.withColumn(ends, F.transform(kinds, lambda k, i: before(i) + F.char_length(F.get(F.col(gaps), i))))
    found = F.filter(
        F.zip_with(kinds, ends, lambda k, at: F.struct(k["kind"].alias("kind"), at.alias("at"), k["was"].alias("was"), k["now"].alias("now"))),
        lambda f: f["kind"].isNotNull(),
    )
    clean = F.array_join(F.zip_with(gaps, kinds, lambda g, k: F.concat(g, F.coalesce(k["now"], F.lit("")))), "")
    some = F.size(kinds) > 0
    kept = [F.when(F.col(c).isNotNull(), F.when(some, clean).otherwise(F.col(c))).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns if c != "found"]
    return rows.select(*kept, F.when(some, found).otherwise(quiet).alias("found"))

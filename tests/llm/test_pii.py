import datetime as dt
import re

from fragmill.llm.pii import pseudonymised

SCHEMA = "text string, doc_id long, kind string, found int, gaps string, _pii_hits string, hits string"


def run(spark, texts, key="k"):
    df = spark.createDataFrame([(t, i, "kind", 1, "g", "h", "i") for i, t in enumerate(texts)], SCHEMA)
    rows = pseudonymised(df, key)
    assert rows.columns == ["text", "doc_id", "kind", "gaps", "_pii_hits", "hits", "found"]
    rows = rows.collect()
    assert all(r[2:6] == ("kind", "g", "h", "i") for r in rows)
    return {r.doc_id: (r.text, [tuple(f) for f in r.found]) for r in rows}


def checked(digits):
    """The digits with their check digit behind them."""
    return next(digits + d for d in "0123456789" if luhn(digits + d) == 0)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed([int(c) for c in digits if c.isdigit()])):
        total += c if i % 2 == 0 else (c * 2 - 9 if c > 4 else c * 2)
    return total % 10


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", text)))


def test_kinds_keep_their_format_and_validity(spark):
    texts = {
        "account": ["4111 1111 1111 1111", "9807-9157-6280-4495", "378282246310005"],
        "phone": ["+1 (017) 555-7713", "555-123-4567", "+44 20 7946 0958"],
        "ip": ["97.51.17.173", "0.0.0.0", "255.255.255.255"],
        "date": ["2024-02-29", "31.12.1999", "01/03/1950"],
        "ssn": ["123-45-6789"],
        "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
        "email": ["Jane.Doe34@mail7.example.com"],
        "secret": ["b44e15e09fd311c3cf3163b66d5a9875b883d8ce", "B44E15E09FD311C3CF3163B66D5A9875B883D8CE", "B44e15e09fd311c3Cf3163b66d5a9875b883d8ce"],
    }
    flat = [(k, v) for k, vs in texts.items() for v in vs]
    got = run(spark, [f"é {v}, so." for _, v in flat])
    for i, (kind, value) in enumerate(flat):
        text, found = got[i]
        assert [f[0] for f in found] == [kind] and found[0][1:3] == (2, value)
        new = found[0][3]
        assert text == f"é {new}, so." and new != value
        if kind == "ip":
            assert all(0 <= int(o) <= 255 for o in new.split("."))
        elif kind == "date":
            form = "%Y-%m-%d" if "-" in value else "%d/%m/%Y" if "/" in value else "%d.%m.%Y"
            assert dt.date(1900, 1, 1) <= dt.datetime.strptime(new, form).date() <= dt.date(2100, 5, 1)
        elif kind == "secret":
            assert re.fullmatch("[0-9a-f]{40}" if value.islower() else "[0-9A-F]{40}" if value.isupper() else "[0-9A-Fa-f]{40}", new)
        elif kind == "email":
            assert new.endswith("@mail7.example.com") and shape(new) == shape(value)
        elif kind == "iban":
            bare = new.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
        else:
            assert shape(new) == shape(value)
        if kind == "account":
            assert luhn(new) == luhn(value) == 0
        if kind == "ssn":
            area, group, serial = map(int, new.split("-"))
            assert 0 < area < 900 and area != 666 and group and serial


def test_invalid_numbers_stay(spark):
    texts = ["30.02.2024", "2024-13-01", "999.1.1.1", "GB82 WEST 1234 5698 7654 33", "Version 2.0.", "1234567", "000-12-3456", "9807915762804490", "1700000000000", "v1.2.3.4.5", "a" * 40]
    for i, (text, found) in run(spark, texts).items():
        assert text == texts[i] and found == []


def test_equal_values_are_linked_and_different_ones_apart(spark):
    days = [f"{dt.date(2000, 1, 1) + dt.timedelta(i)}" for i in range(400)]
    numbers = [checked(f"{400000000000000 + i}") for i in range(400)]
    got = run(spark, [" ; ".join(days), " ; ".join(numbers), "x " + days[7] + " y " + numbers[3]])
    first, second, third = ([f[3] for f in got[i][1]] for i in range(3))
    assert len(set(first)) == 400 and len(set(second)) == 400 and third == [first[7], second[3]]
    assert run(spark, [days[7]], "other key")[0][0] != first[7]


def test_odd_rows(spark):
    got = run(spark, [None, "", "z " * 100_000 + "97.51.17.173", "97.51.17.173", "97.51.17.173"])
    assert got[0] == (None, []) and got[1] == ("", []) and got[3] == got[4]
    assert got[2][0] == "z " * 100_000 + got[3][0]
    assert pseudonymised(spark.createDataFrame([], SCHEMA), "k").count() == 0


def test_values_are_found_beside_others(spark):
    iban, card = "ES91 2100 0418 4502 0005 1332", "4111 1111 1111 1111"
    texts = [f"{iban} EUR", "BE68 5390 0754 7034 BIC", iban, f"{card} 12", f"5 {card}", card, "4111111111111111 300", f"XY12 {card}"]
    got = run(spark, texts)
    assert [[f[:3] for f in got[i][1]] for i in range(8)] == [
        [("iban", 0, iban)],
        [("iban", 0, "BE68 5390 0754 7034")],
        [("iban", 0, iban)],
        [("account", 0, card)],
        [("account", 2, card)],
        [("account", 0, card)],
        [("account", 0, "4111111111111111")],
        [("account", 5, card)],
    ]
    iban, card = got[2][0], got[5][0]
    assert [got[i][0] for i in (0, 3, 4, 7)] == [f"{iban} EUR", f"{card} 12", f"5 {card}", f"XY12 {card}"]
    assert got[6][0] == card.replace(" ", "") + " 300"


def test_month_first_dates_and_unseparated_phones(spark):
    days = [(dt.date(2000, 1, 1) + dt.timedelta(i)) for i in range(200)]
    texts = [f"{d:%m/%d/%Y}" for d in days if d.day > 12] + ["+442079460958"]
    got = run(spark, texts)
    new = [got[i][0] for i in range(len(texts))]
    assert all(len(got[i][1]) == 1 for i in got) and len(set(new)) == len(texts) and all(n != t for n, t in zip(new, texts))
    assert all(dt.datetime.strptime(n, "%m/%d/%Y").day > 12 for n in new[:-1])
    assert got[len(texts) - 1][1][0][0] == "phone" and shape(new[-1]) == shape(texts[-1])


def test_a_phone_is_one_however_it_is_written(spark):
    got = run(spark, ["+44 20 7946 0958", "+44-20-7946-0958", "+442079460958", "+44 20 7946 0959"])
    assert [got[i][0] for i in (1, 2)] == [got[0][0].replace(" ", "-"), got[0][0].replace(" ", "")] and got[3][0] != got[0][0]


def test_many_matches_of_one_text_are_placed_in_linear_time(spark):
    one = "é 97.51.17.173 and 123-45-6789; "
    text = one * 3000
    (now, found), = run(spark, [text]).values()
    assert len(found) == 6000 and all(text[at : at + len(was)] == was for _, at, was, _ in found)
    assert now == found[0][3].join(["é ", f" and {found[1][3]}; "]) * 3000


def test_long_halves_are_not_shifted_alike(spark):
    (now, _), = run(spark, ["0a" * 32]).values()
    assert len({now[i : i + 16] for i in range(0, 64, 16)}) == 4


def test_ssns_stay_apart(spark):
    numbers = [f"{a:03d}-{g:02d}-0001" for a in (1, 665, 667, 899) for g in range(1, 60)]
    got = run(spark, [" ; ".join(numbers)])
    new = [f[3] for f in got[0][1]]
    assert len(set(new)) == len(numbers) and all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", n) for n in new)

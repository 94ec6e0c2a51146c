import hashlib
import re

from fragmill.llm import exact_dedup as E

SCHEMA = "h string, text string, doc_id long, keep_id long, body string"


def brute(rows):
    norm = [(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), d) for t, d in rows]
    out = []
    for t, d in norm:
        ids = [i for u, i in norm if u == t]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([("x", t, d, 0, "y") for t, d in rows], SCHEMA)


def test_odd_rows(spark):
    rows = [(None, 5), ("", 3), (" ", 9), ("\n\t", 2), ("a  b", 4), ("a\nb", 1), ("a b", 1), ("a b", 7), ("z" * 200_000, 8), ("q", None), ("q", None)]
    assert sorted(map(tuple, E.exact_duplicates(frame(spark, rows)).collect()), key=repr) == brute(rows)
    assert E.exact_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_colliding_hashes_stay_apart(spark, monkeypatch):
    rows = [("aa", 3), ("ab", 1), ("aa", 2), ("ab", 4), ("b", 5)]
    md5 = E.F.md5
    monkeypatch.setattr(E.F, "md5", lambda c: md5(E.F.substring(c, 1, 1)))
    got = E.exact_duplicates(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)

import random

from fragmill.llm.linededup import fingerprints, line_dedup


def brute(docs, least):
    """Every run of lines of each text, and whether it began earlier elsewhere."""
    seen, out = {}, {}
    for doc_id, text in sorted(docs):
        lines = text.split("\n")
        gone = set()
        for s in range(len(lines)):
            words = 0
            for e in range(s, len(lines)):
                words += len(lines[e].split())
                if words >= least:
                    run = tuple(lines[s : e + 1])
                    if seen.setdefault(run, (doc_id, s)) < (doc_id, s):
                        gone |= set(range(s, e + 1))
        out[doc_id] = (sorted(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_against_every_run(spark):
    rng = random.Random(5)
    for least in (1, 4, 9):
        docs = [(i, "\n".join(" ".join("w" * rng.randint(0, 2) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 14)))) for i in range(60)]
        passage = "\n".join("p%d q r" % i for i in range(5))
        docs += [(100 + i, f"{i} own\n{passage}\n{i} more") for i in range(6)]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = {r.doc_id: (list(r.removed), r.text) for r in line_dedup(df, least).collect()}
        assert got == brute(docs, least)


def test_a_passage_goes_and_clean_texts_stay(spark):
    passage = " ".join(f"word{i}" for i in range(55))
    docs = [(i, f"Intro {i} of its own.\n{passage}\nEnd {i}.") for i in range(5)] + [(9, "Short line.\nShort line."), (8, "Short line.\nClean.")]
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0] == docs[0][1] and got[9] == docs[5][1] and got[8] == docs[6][1]
    assert all(got[i] == f"Intro {i} of its own.\nEnd {i}." for i in range(1, 5))


def test_odd_rows(spark):
    long = "\n".join(f"l{i % 70} a b" for i in range(220))
    rows = [(1, None, "s", 3), (2, "", "s", 4), (None, "a b c d", None, 5), (3, "a b c d", "t", 6), (4, long, "t", 7), (5, "x y z w", "t", 8), (5, "x y z w", "u", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, first string, fp int")
    got = line_dedup(df, 4)
    assert got.columns == ["doc_id", "text", "first", "fp", "removed"]
    found = {r.fp: (r.text, len(r.removed)) for r in got.collect()}
    assert found[3] == (None, 0) and found[4] == ("", 0) and found[5] == ("a b c d", 0) and found[6] == ("", 1)
    assert found[8] == found[9] == ("x y z w", 0)
    assert found[7][1] == brute([(4, long)], 4)[4][0].__len__()
    assert line_dedup(df.limit(0)).count() == 0


def test_clashing_columns_stay(spark):
    names = ["_id", "_body", "_spans", "_out", "key", "body", "spans", "out", "fp", "n", "run", "_salt", "salt"]
    df = spark.createDataFrame([(i, "a b\nc d", *names) for i in range(3)], f"doc_id long, text string, {' string, '.join(names)} string")
    got = line_dedup(df, 4)
    assert got.columns == [*df.columns, "removed"]
    rows = got.orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["a b\nc d", "", ""] and all(list(r)[2:-1] == names for r in rows)


def test_a_text_of_blank_lines_takes_linear_time(spark):
    import time

    from fragmill.llm.linededup import chosen

    def seconds(n):
        text = "\n" * n + "a b c d e\n" * 20 + "\n" * n
        start = time.perf_counter()
        chosen([1], [1], [text], 50)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(200_000) < 60 * seconds(10_000) + 1


def test_lines_that_windows_share_are_chosen_once(spark):
    text = "\n".join(f"line {i} of a text" for i in range(400))
    rows = fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string"), 50).collect()
    assert len(rows) < sum(len(r.windows) for r in rows) / 4 and len({r.at for r in rows}) == len(rows)

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fragmill.llm import alignment, queries
from fragmill.llm.alignment import Aligner, PerfectHash, aligned, pair_counts

JSON, MODEL = (public_tokenizers.path(name) for name in queries.ALIGNED)
TOOLS = Path(JSON).read_text("utf-8"), Path(MODEL).read_bytes(), public_tokenizers.PATTERN
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(docs: list[tuple]) -> list[tuple]:
    """By the two libraries over whole texts, with offsets as sets."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a.encode_special_tokens = True
    letters = alignment._bytes_of_letters()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    found, count = [], Counter()
    for doc, text in docs:
        one = (0, 0, "", [])
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False), b.encode(text)
            raw = (" " + text).encode()
            ax = [bytes(letters[c] for c in a.id_to_token(i)) for i in x.ids]
            bx = [b_bytes(i) for i in y]
            if b"".join(ax) == raw == b"".join(bx):
                ends_a = {int(e): k for k, e in enumerate(np.cumsum([len(t) for t in ax]))}
                ends_b = {int(e): k for k, e in enumerate(np.cumsum([len(t) for t in bx]))}
                groups, links, i, j = [], [], 0, 0
                for e in sorted(ends_a.keys() & ends_b.keys()):
                    k, m = ends_a[e], ends_b[e]
                    groups.append(",".join(map(str, x.ids[i : k + 1])) + "|" + ",".join(map(str, y[j : m + 1])))
                    links.append((x.ids[k], y[m]))
                    i, j = k + 1, m + 1
                one = (len(x.ids), len(y), ";".join(groups), links)
        count.update(one[3])
        found.append((doc, *one))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(
        [
            (doc, n_a, n_b, len(links), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else "")
            for doc, n_a, n_b, text, links in found
        ],
        key=repr,
    )


def result(df) -> list[tuple]:
    return sorted([tuple(r[c] for c in COLUMNS) for r in df.collect()], key=repr)


ODD = [
    (1, "The quick  brown fox.\n\n It's   done "), (2, None), (3, ""), (4, " "), (5, "a▁b"), (6, "<|endoftext|> <s> </s> <0x41>"), (7, "naïve café 日本語 ﬁ ½ 😀 end"),
    (8, "x\x00y \x1c z\x85 w q　r ﻿"), (9, "word " * 5000 + "z" * 9000), (10, "don't we'll I've 12 345 6"), (10, "don't we'll I've 12 345 6"), (None, "the quick brown"), (11, "a ▁"), (12, "\t\n\r lines\r\n of  text\n"), (13, "many words ▁ in one text, " + "and x▁y more " * 3),
    (14, "\x1c a\x1c b \x1d c"), (15, "café\u0301 x\u0301y \u0301z"),
]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_odd_texts_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", limit)
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("code", F.lit("clash")).withColumn("n_a", F.lit(1))
    assert result(aligned(df, *TOOLS)) == brute(ODD)
    assert aligned(df.limit(0), *TOOLS).collect() == []


def test_bounds_within_tasks_change_nothing(spark, monkeypatch):
    for name in ("COUNTED", "TURN", "TOGETHER", "PART", "FAN"):
        monkeypatch.setattr(alignment, name, 2)
    df = spark.createDataFrame(ODD[:8] * 2, "doc_id long, text string").repartition(5)
    assert result(aligned(df, *TOOLS)) == brute(ODD[:8] * 2)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000, 5000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
    found = PerfectHash.of(keys)
    assert sorted(found.places(keys).tolist()) == list(range(len(keys)))
    assert (found.places(np.array([1 << 41, (1 << 41) + 1])) == -1).all()


def test_vectors_are_added_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 3)
    monkeypatch.setattr(alignment, "PART", 10)
    rows = [(c * 7919, c + b, b) for b in range(40) for c in range(b % 5, 60)]
    total = Counter()
    for code, n, _ in rows:
        total[code] += n
    found = {}
    for r in pair_counts(spark.createDataFrame(rows, "code long, n long, branch long")).collect():
        _, keys, vector = alignment._unpacked(r)
        found |= dict(zip(keys.tolist(), vector.tolist()))
    assert found == dict(total)


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError, match="order"):
        Aligner(TOOLS[0].replace('"merges":["Ġ t","Ġ a"', '"merges":["Ġ a","Ġ t"').replace('"merges":[["Ġ","t"],["Ġ","a"]', '"merges":[["Ġ","a"],["Ġ","t"]'), *TOOLS[1:])


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(queries.op12_cross_tokenizer_alignment(spark, folder)) == brute(docs)

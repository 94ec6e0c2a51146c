import hashlib
from array import array

import corpus_pipeline as P
import public_tokenizers
import tiktoken
from test_linededup import brute as lines_brute
from test_neardup import brute as groups_brute

from fragmill.llm import bpe


def test_stages_are_as_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, columns = [n for n, _ in P.STAGES], docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in P.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        assert len({r.doc_id for r in rows}) == len(rows)
        if name != names[-1]:
            assert docs.columns == columns
        now = {r.doc_id: r.text for r in rows} if name != names[-1] else {}
        if name in ("quality", "mixing"):
            assert 0 < len(now) <= len(before) and all(before[d] == t for d, t in now.items())
        elif name == "line_dedup":
            want = lines_brute(list(before.items()), 50)
            assert now == {d: t for d, (_, t) in want.items()} and all(r.n_chars == len(r.text) for r in rows)
        elif name == "near_dedup":
            assert set(now) == set(groups_brute([(t, d) for d, t in before.items()]).values())
        else:
            ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path(P.VOCABULARY)))
            known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            for r in rows:
                assert list(array("I", r.tokens)) == known.encode_ordinary(before[r.doc_id]) and r.n_tokens == len(r.tokens) // 4
                assert r.decoded_sha256 == hashlib.sha256(before[r.doc_id].encode()).hexdigest()
        before = now


def test_empty_table_and_nulls(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    for rows in (docs.limit(0), odd):
        for _, stage in P.STAGES:
            rows = stage(spark, rows, sf)
        assert rows.count() <= 2

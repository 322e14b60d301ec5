"""Registered queries against their SQL, and the pipeline against brute force."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm.byte_bpe import read_ranks
from shelfwise.llm.quality import quality_rules
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.sql import ORACLE
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def rows(frame):
    shown = lambda x: None if pd.isna(x) else int(x) if isinstance(x, (float, np.integer)) and float(x).is_integer() else x
    return sorted(repr([shown(x) for x in r]) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_periodic_runs_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, text in texts.items():
        words = brute.WORD.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute.runs(words, 12)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        gone = {k for s, size, q in runs for k in range(s + q, s + size)}
        want[i] = (len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert got == want
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_pipeline_equals_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in documents.collect()}
    # Verdicts come from the quality query, which has SQL of its own.
    kept = {r.doc_id for r in quality_rules(documents).where("kept").collect()}
    texts = {i: t for i, t in texts.items() if i in kept}
    near = brute.components(list(texts.items()), 5, 80)
    texts = {i: t for i, t in texts.items() if near[i][1] == i}
    cut = {}
    for i, (data, gone) in brute.kept_bytes(list(texts.items()), 100).items():
        at, out = 0, ""
        for c in data.decode():
            size = len(c.encode())
            out += "" if all(gone[at:at + size]) else c
            at += size
        cut[i] = out
    items = [letters(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i: t for i, t in cut.items() if not any(x in letters(t) for x in items)}
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {i: (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in clean.items() for ids in [bpe.encode_ordinary(t)]}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()} == want


def letters(text):
    return bytes(b for b in text.encode().lower() if chr(b).isalnum() and b < 128 or b >= 128)


def test_stages_on_unusual_rows(spark):
    """Null columns, empty and long texts, repeated rows, an empty table; columns stay."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (9001, None, "en", "src0", 0), (9002, "", None, None, 0), (9003, "word " * 30000, "en", "src0", 150000), (9003, "word " * 30000, "en", "src0", 150000), (None, "Some text without an id. " * 4, "en", "src0", 1)]
    docs = documents.unionByName(spark.createDataFrame(odd, documents.schema))
    for frame in (docs, documents.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == documents.columns
            assert out.count() <= frame.count()
        last = corpus_pipeline.STAGES[-1][1](spark, frame, SF)
        assert last.count() == frame.count() and last.where(F.col("n_tokens").isNull()).count() == 0

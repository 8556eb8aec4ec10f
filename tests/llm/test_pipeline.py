"""Queries against their SQL, and the corpus pipeline against a brute-force version."""

import collections

import pytest
from oracle import connected, same

import corpus_pipeline
from strandweave.llm import packing, quality, secrets
from strandweave.llm.queries import QUERIES, oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df, sql = QUERIES[name](spark, SF), oracle_sql()
    if name in sql:
        same(connected(SF), df, sql[name])
    else:
        assert df.count() > 0


def test_pipeline(spark):
    import re

    import zstandard
    from test_operators import brute_fingerprint, brute_secrets, tokens

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    squeeze = zstandard.ZstdCompressor(level=quality.LEVEL)
    rows = [r for r in rows if quality.judge_text((r.text or "").encode(), squeeze)[6]]
    fps = [brute_fingerprint(r.text) for r in rows]
    label = list(range(len(rows)))
    for _ in range(10):
        for a in range(len(rows)):
            for b in range(a):
                if bin(fps[a] ^ fps[b]).count("1") <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for r, x in zip(rows, label, strict=True):
        least[x] = min(r.doc_id, least.get(x, r.doc_id))
    rows = [r for r, x in zip(rows, label, strict=True) if least[x] == r.doc_id]
    windows = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = tokens(r.text)
        for k in range(max(len(w) - 9, 1)):
            if w:
                windows[w[k]].append(w[k : k + 10])
    clean = []
    for r in rows:
        w = tokens(r.text)
        if not any(w[k : k + len(x)] == x for k in range(len(w)) for x in windows.get(w[k], ())):
            clean.append(r)
    assert 0 < len(clean) < 200
    encoder, want, masked = packing.Encoder(), collections.Counter(), 0
    for r in clean:
        text, at = [], 0
        for s, e, *_ in brute_secrets(r.text):  # the models find nothing more in these texts
            text += [r.text[at : max(s, at)], "[SECRET]" if s >= at else ""]
            at, masked = max(at, e), masked + 1
        ids = encoder.encode("".join(text) + r.text[at:]) + [packing.END_ID]
        for piece, (start, n) in enumerate(packing.pieces_of(len(ids))):
            want[r.doc_id, piece, start, n] += 1
    found = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length) for r in found) == want
    assert re.match("quality", corpus_pipeline.STAGES[0][0]) and secrets.KINDS
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0

"""The pipeline's stages against plain versions of their decisions."""

import re

import numpy as np
from edges import SF, documents, table
from test_neardup import brute
from test_text import ITEM, forms
from test_tokens import library_ids

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries


def test_whole_run(spark):
    squeeze = lambda t: " ".join((t or "").lower().split())
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    named = {d: c for d, (_, c) in brute(texts).items()}
    items = [squeeze(r.text) for r in table(spark, "benchmark").collect()]
    kept = {d: t for d, t in texts.items() if named[d] == d and not any(i in squeeze(t) for i in items)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(kept)
    for r in rows:
        text = kept[r.doc_id]
        spans = [tuple(map(int, s.split(":")[1:])) for s in forms(text)]
        for a, b in reversed(spans):
            text = text[:a] + "[SECRET]" + text[b:]
        assert np.frombuffer(r.ids, "<u4").tolist() == library_ids(text) and r.n_tokens == len(r.ids) // 4


def test_stages_keep_the_columns(spark):
    rows = [(1, f"Some text. {ITEM}"), (2, "token = abcdefgh12345"), (3, None), (None, "no id here but the words are of the language"), (2, "token = abcdefgh12345")]
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= len(rows)
    masked = {r.text for r in corpus_pipeline.secret_scan(spark, docs, SF).collect()}
    assert not any(re.search("abcdefgh", t or "") for t in masked)
    assert corpus_pipeline.token_ids(spark, docs, SF).count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), SF).count() == 0


def test_registered():
    found = queries()
    assert "pipeline" in found and all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 14))
    assert set(oracle_sql()) <= set(found)

"""The registered queries against SQL or plain versions, and the pipeline stage by stage."""

from __future__ import annotations

import re
from collections import Counter

import compare
import pytest
from test_nearcopies import plain_groups
from test_text_maps import plain_base_secrets, plain_hits

import __spark_entry__ as entry
import corpus_pipeline
from muniment.llm import quality, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.ORACLE[name]) is None


def test_all_are_registered():
    names = entry.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names


def test_pipeline_stage_by_stage(spark):
    source = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    columns = list(next(iter(source.values())).__fields__)
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = []
    for name, fn in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(fn(spark, docs, SF), name.replace(" ", "-"))
        results.append({r.doc_id: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    good, single, clean, masked, coded = results
    assert set(good) == {i for i, k in verdict.items() if k}
    ids = sorted(good)
    groups = plain_groups([good[i].text for i in ids])
    assert set(single) == {ids[g] for g in set(groups)} and len(single) < len(good)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(clean) == {i for i, r in single.items() if plain_hits(r.text, items, 10)[1] == 0}
    assert set(masked) == set(clean) == set(coded)
    for i, r in masked.items():
        assert (r.text == source[i].text) == (not plain_base_secrets(source[i].text)) and not plain_base_secrets(r.text) and r.n_chars == len(r.text)
        assert coded[i].round_trip and coded[i].text == r.text
    assert Counter(corpus_pipeline.run(spark, SF).select("doc_id").collect()) == Counter(docs.select("doc_id").collect())

from __future__ import annotations

import re

import pytest

import corpus_pipeline as pipeline
from metroscope.llm.queries import ORACLES, QUERIES
from metroscope.llm.tokens import Encoder, vocabulary

from ..oracle import compare, connect
from . import awkward
from .test_similar import brute

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The awkward documents and labels as tables."""
    path = tmp_path_factory.mktemp("tables")
    awkward.frame(spark).select(*pipeline.COLUMNS).write.parquet(f"{path}/documents.parquet")
    marks = [(r[0], int(r[0] % 3 > 0), 0, None, None, None) for r in awkward.documents() if r[0] is not None and r[0] < 110]
    spark.createDataFrame(marks, awkward.LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = pipeline.quality_rules(spark, docs, folder)
    assert kept.columns == list(pipeline.COLUMNS)
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert texts and all(len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= 20 for _, t in texts)
    one_each = pipeline.ngram_jaccard_join(spark, kept, folder)
    want = {(i, t) for (i, t) in texts if (i, i) in {(a, c) for a, _, c in brute(texts)}}
    assert {(r["doc_id"], r["text"]) for r in one_each.collect()} == want and one_each.count() == len(want)
    clean = pipeline.secret_scans(spark, one_each, folder)
    assert clean.count() == len(want)
    mixed = pipeline.source_mixing(spark, clean, folder)
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, clean.collect()))
    pieces = pipeline.packing(spark, mixed, folder).collect()
    encoder = Encoder(vocabulary("byte_bpe_50k.json"))
    assert sum(p["length"] for p in pieces) == sum(len(encoder.ids(r["text"])) // 4 + 1 for r in clean.collect())


def test_run_writes_every_stage(spark, folder):
    assert pipeline.run(spark, folder).count() > 0


def test_empty_tables_pass(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_secrets_are_gone(spark):
    rows = [(1, "x password=hunter2hunter2 y", "en", "src0", 27), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, COLUMNS)
    assert [tuple(r) for r in pipeline.secret_scans(spark, docs, "").orderBy("doc_id").collect()] == [(1, "x [SECRET] y", "en", "src0", 12), rows[1]]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    assert compare(QUERIES[key](spark, FOLDER), connect(FOLDER), ORACLES[key]) is None


def test_contract():
    import __spark_entry__ as contract

    names = contract.queries()
    assert {"pipeline", *QUERIES} <= set(names) and len([n for n in names if re.match(r"op\d+_", n)]) == len(QUERIES)

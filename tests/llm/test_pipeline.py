"""The pipeline: every stage on odd tables, and what it keeps against plain versions."""

from __future__ import annotations

import pytest

import corpus_pipeline
from starloom.llm import queries
from tests.llm.test_operators import SMALL, linked
from tests.oracle import compare, connect

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, quality_kept boolean, dup_kept int"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The table before the first stage and after each."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, out[-1], SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_and_subsets(kept):
    for before, after in zip(kept[:-2], kept[1:-1], strict=True):
        assert after.columns == kept[0].columns
        assert after.exceptAll(before).count() == 0 and 0 < after.count() < before.count()


def test_stages_decide_as_the_operators_do(spark, kept):
    toxic = {r.doc_id for r in queries.op7_toxicity(spark, SMALL).where("predicted = 1").collect()}
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert ids[0] - ids[1] == toxic
    good = {r.doc_id for r in queries.op10_quality_rules(spark, SMALL).where("kept").collect()}
    assert ids[2] <= ids[1] and len((ids[1] & good) ^ ids[2]) <= 0.05 * len(ids[1])  # the rules are learnt on what is left
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    last = {}
    for i, t in rows:
        last[t] = max(last.get(t, i), i)
    assert ids[3] == set(last.values())
    rows = [(r.doc_id, r.text) for r in kept[3].collect()]
    assert ids[4] == {c for _, _, c in linked(rows)}
    assert ids[5] == ids[4]


def test_odd_tables(spark):
    rows = [(1, None), (2, ""), (None, "one two three"), (3, "one two three"), (3, "one two three"), (4, "a b c d e f g h i j k " * 30)]
    odd = spark.createDataFrame([(i, t, None, None, None, 0.5, "f", True, 1) for i, t in rows], EXTRA)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert name == "best_fit_packing" or out.columns == docs.columns
            assert out.count() <= 2 * docs.count()
    assert corpus_pipeline.drop_copies(spark, odd, SMALL).count() == 3
    near = corpus_pipeline.drop_near_copies(spark, odd, SMALL).select("doc_id").collect()
    assert sorted(r.doc_id or 0 for r in near) == [1, 2, 3, 4]


@pytest.mark.parametrize("stored", [False, True])
def test_no_unlinked_document_goes_with_a_null_or_repeated_id(spark, tmp_path, stored):
    a, other, third = "a b c d e f g h i j " * 9, "k l m n o p q " * 20, "r s t u v w " * 20
    rows = [(1, a), (None, a), (None, other), (7, third), (7, a), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, None, None, None, 0.5, "f", True, 1) for i, t in rows], EXTRA)
    if stored:
        docs.repartition(3).write.parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
    left = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id or 0), r.text or "") for r in left.collect())
    assert got == sorted([(1, a), (0, other), (7, third), (0, ""), (0, "")])


@pytest.mark.parametrize("name", ["op6_ngram_jaccard_join", "op9_exact_dedup"])
def test_against_sql(spark, name):
    q = queries.REGISTRY[name]
    assert compare(q.run(spark, SMALL), connect(SMALL), q.sql) is None

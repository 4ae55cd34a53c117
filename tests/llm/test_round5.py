"""Texts of rows that stay aren't shuffled by near-duplicate removal; training texts ask for no pair that they know."""

import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from starloom.llm import encode, lm, packing, toxicity


@pytest.mark.parametrize("most", [corpus_pipeline.MOST_PAGES, 0])
def test_rows_that_leave_are_bits(spark, monkeypatch, most):
    monkeypatch.setattr(corpus_pipeline, "MOST_PAGES", most)
    keys = [0, 7, 8, (1 << 15) - 1, 1 << 15, (5 << 40) + 9, (1 << 62) + 1]
    rows = spark.createDataFrame([(k, f"t{k}") for k in [*keys, *keys, 3, 15, (5 << 40) + 10]], "k long, text string")
    leave = spark.createDataFrame([(k,) for k in [*keys, 1]], "member long")
    assert sorted(r.k for r in corpus_pipeline.without(spark, rows, leave, "k").collect()) == [3, 15, (5 << 40) + 10]
    assert corpus_pipeline.without(spark, rows, leave.limit(0), "k").count() == 17
    assert corpus_pipeline.without(spark, rows, leave, "k").columns[:2] == ["k", "text"]


def test_no_text_is_shuffled_to_the_rows_that_leave(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(40))
    spark.createDataFrame([(k, text if k < 3 else f"{k} other words of row {k}") for k in range(30)], "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stay = corpus_pipeline.drop_near_copies(spark, docs, "")
        assert "SortMergeJoin" not in stay._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in stay.collect()) == [0, *range(3, 30)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_fit_gives_its_memory_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr(toxicity, "give_back", lambda: given.append(1))
    toxicity.fit_frame(spark.createDataFrame([("you fool", 1), ("a day", 0)], "text string, label int"), "text", "label")
    assert given == [1]


@pytest.mark.parametrize("lowest", [2, 3])
def test_training_texts_get_what_is_over_one(spark, tmp_path, lowest):
    """Answers hold no level that is known without asking, and none that matters is missing."""
    rng = random.Random(3)
    word = [f"w{k}" for k in range(2500)]
    texts = [" ".join(rng.choices(word, k=150)) for _ in range(90)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, " ".join(t.split()[:75]) + " w1 new") for i, t in enumerate(texts[:20])]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    rows = lm.read_blocks(spark, f"{tmp_path}/d", "doc_id", "text", "doc_id < 1000")
    totals = lm.word_totals(rows)
    whole = lm.build_filter(rows, totals)
    model = next(m for k in range(16, 10, -1) if (m := lm.build_filter(rows, totals, 1 << k)).lowest == 2)
    model = replace(model, lowest=lowest)  # with 3, pairs of level 2 are asked for too
    answers = lm.rare_levels(rows, model).collect()
    levels = [x for r in answers for x in r.levels]
    assert levels and all(x > 0 for x in levels)
    asked_by_all = sum(len(r.levels) for r in answers)
    column = pa.array([t for _, t in docs], pa.large_string())
    known = sorted({(r.seg << lm.KEY_BITS) | int(k): x for r in answers for k, x in zip(lm._unpacked_keys(r.keys), r.levels, strict=True)}.items())
    rare = np.array([k for k, _ in known], np.uint64), np.array([x for _, x in known], np.int64)
    (first, n, row, h), = lm.tokens(column)
    learnt, two = (np.arange(n) < 90)[row], lm.pairs(row, h)
    unit, counts = np.unique(two[learnt], return_counts=True)
    count = np.array([dict(zip(unit.tolist(), counts.tolist(), strict=True)).get(x, 0) for x in two.tolist()])
    true = np.searchsorted(lm.LEVELS, count, "right")
    got = np.maximum(model.all_levels(two, rare), learnt)
    assert (got >= true).all() and (got == true).mean() >= (whole.levels(two) == true).mean() - 0.005
    assert asked_by_all < ((true == 1) & learnt).sum() / 2  # a training text's single pairs don't travel back


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_cut_together_encode_like_whole_ones(name):
    rng = random.Random(8)
    pieces = [*"ab Zé'5- \n\t.ß", " ", "  ", "'s", "'re", "'LL", "don't", "\r\n", "É", "ɏ", "ı", "\x1c", "×", "İ", "中", "é", "\xa0", "12,3"]
    own = encode.Encoder(name)
    own.tokenizer.encode_special_tokens = True
    for k in range(400):
        some = pieces[: 20 if k % 2 else len(pieces)]
        texts = ["".join(rng.choices(some, k=rng.randrange(25))) if rng.random() > 0.1 else None for _ in range(12)]
        whole = [np.array(own.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert own.encode(texts) == whole


def test_shared_chunks_are_looked_up_once(monkeypatch):
    own = encode.Encoder("byte_bpe_50k.json")
    asked = []
    monkeypatch.setattr(own, "known", type("K", (encode.Known,), {"get": lambda self, c: asked.append(c), "__getitem__": lambda self, c: asked.append(c) or b""})())
    own.encode(["the day the night"] * 50)
    assert len(asked) == 4  # "the", " day", " the", " night"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("wrong", [False, True])
def test_new_chunks_go_to_the_tokenizer_as_lines(name, wrong):
    own = encode.Encoder(name)
    if wrong:  # ids that can't be told apart are those of chunks alone
        own.widths[:] = 1
    plain, calls = own.tokenizer, []
    chunks = ["the", "night", "'s", "don't", "12", "...", "é", "\n", "中", "x'5", "AB", "ab1" * 200]
    whole = [np.array(plain.encode(c, add_special_tokens=False).ids, "<u4").tobytes() for c in chunks]
    own.tokenizer = type("T", (), {"encode_batch_fast": lambda self, part, **k: (calls.append(len(part)), plain.encode_batch_fast(part, **k))[1]})()
    assert own._ids(chunks) == whole
    assert calls[0] == 1 and (wrong or sum(calls) < len(chunks) / 2)


def test_an_idle_worker_remembers_no_chunks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a day")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = packing.token_pieces(docs, "doc_id", "text", 4096, 1, "word_bpe_49k.json")
    rows = run(iter([pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a day", "a night"]})]))
    own = encode.encoder("word_bpe_49k.json", marks=True)
    assert next(rows).num_rows == 2 and own.known
    assert not list(rows) and not own.known and own.size == 0

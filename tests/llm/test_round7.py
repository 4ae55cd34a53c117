"""What the fourth round's findings named, each with a table that showed it."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest

from starloom.llm import dedup, jaccard, lm
from tests.llm.test_operators import linked

# ---- 1, 3


def chained(n: int) -> list[tuple[int, str]]:
    """Each text shares a passage with the next one and few are links, so all are one component of candidates."""
    passage = [" ".join(f"p{k}w{j}" for j in range(14)) for k in range(n + 1)]
    rows = [(k, f"{passage[k]} {passage[k + 1]}") for k in range(n)]
    return rows + [(1000 + k, f"{rows[k][1]} more") for k in range(0, n, 7)] + [(2000, " ".join(f"l{j}" for j in range(1500))), (2001, " ".join(f"l{j}" for j in range(1499)))]


def test_candidates_that_hang_together_by_passages_fall_apart(spark, monkeypatch):
    """Before, a set went to as many tasks as its component of candidates had blocks: disk grew with the square."""
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 400)
    rows = chained(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = jaccard.set_table(docs, "doc_id", "text").cache()
    sets = table.where("n > 0").selectExpr("fp", "id", "n")
    routed = jaccard._routed(jaccard._candidates(docs, "text").cache(), table, sets).collect()
    assert {r.id for r in routed if r.blocks > 1} <= {2000, 2001}  # a link that is over the bound by itself
    assert {r.id for r in routed} >= {i for i, _, c in linked(rows) if any(c == d and i != j for j, _, d in linked(rows))}
    got = jaccard.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == linked(rows)


def test_no_link_is_ruled_out_by_parities():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, (30, 1400), dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(n) < 0.05, rng.integers(0, 2**63, n, dtype=np.uint64), base[k % 30, :n])) for k, n in enumerate(np.tile(rng.integers(1, 1400, 30), 10))]
    size = np.array([len(x) for x in sets])
    bits = jaccard.parities(np.repeat(np.arange(300), size), np.concatenate(sets), size)
    marked = np.array([len(b) > 0 for b in bits])
    assert (marked == (size <= jaccard.MOST_PARITIES)).all() and not marked.all()
    content = np.array([np.frombuffer(b or bytes(64), np.uint64) for b in bits])
    up = jaccard.Union(300)
    up.join(*jaccard.near_pairs(size, content, marked))
    roots, links = up.roots(), 0
    for i in range(300):
        for j in range(i % 30, i, 30):
            if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (size[i] + size[j]):
                assert roots[i] == roots[j]
                links += 1
    assert links > 50 and len(set(roots.tolist())) > 10


def test_the_copy_that_locators_point_at_goes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dedup, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    rows = [(1, "a"), (2, "b"), (3, "a"), (None, "c"), (4, None), (5, "")]
    got = dedup.drop_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id or 0, r.text or "") for r in got.collect())) == [(0, "c"), (2, "b"), (3, "a"), (5, "")]
    assert not (tmp_path / "dedup-input").exists() and (tmp_path / "dedup-rows").exists()


# ---- 7


def plain_weight(texts: list[str]) -> float:
    """The best of WEIGHTS for these training texts, from exact counts without a token's own occurrence."""
    toks = [[*(t or "").split(), None] for t in texts]
    one = collections.Counter(w for ws in toks for w in ws)
    two = collections.Counter(p for ws in toks for p in zip([None, *ws], ws))
    total, distinct = sum(one.values()), len(one)
    fit = [0.0] * len(lm.WEIGHTS)
    for ws in toks:
        for a, b in zip([None, *ws], ws):
            alone = (one[b] - 0.5) / (total + 0.5 * (distinct + 1))
            before = one[a] - 1
            after = min((lm.VALUE[np.searchsorted(lm.LEVELS, two[a, b], "right")] - 1) / before, 1.0) if before else 0.0
            for k, w in enumerate(lm.WEIGHTS):
                fit[k] += math.log10(w * max(after, 0.0) + (1 - w) * alone if before else alone)
    return lm.WEIGHTS[int(np.argmax(fit))]


def test_the_pairs_weight_is_that_of_all_training_texts(spark, tmp_path, monkeypatch):
    """One block of forty holds nearly all that pairs say; the weight is the same however rows are cut into blocks."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(300)], k=20)) for _ in range(156)]
    texts += [" ".join(f"p{k % 90}" for k in range(j, j + 3000)) for j in range(4)]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")

    def scores(block_rows: int) -> list[float]:
        monkeypatch.setattr(lm, "BLOCK_ROWS", block_rows)
        return [r.score for r in lm.score(spark, f"{tmp_path}/d", "true").orderBy("id").collect()]

    one_block, many = scores(2048), scores(4)
    assert many == pytest.approx(one_block, rel=1e-9)
    monkeypatch.setattr(lm, "WEIGHTS", (plain_weight(texts),))
    assert plain_weight(texts) > 0.3 and scores(2048) == pytest.approx(one_block, rel=1e-9)


def test_log10_sums_are_those_of_the_smoothed_probabilities():
    rng = np.random.default_rng(2)
    m = lm.Filter(np.zeros(0, np.uint8), 1, 8, total=10**9, distinct=10**6, texts=50)
    rows = np.repeat(np.arange(5), [1, 40, 0, 16, 33])
    count, level = rng.integers(0, 1000, len(rows)), rng.integers(0, 5, len(rows))
    for own in (0, 1):
        alone, after, before = m.shares(level, rows, count, own)
        for k, weight in enumerate(lm.WEIGHTS):
            w = np.where(before > 0, weight, 0.0)
            want = np.bincount(rows, np.log10(w * after + (1 - w) * alone), 5)
            assert m.log10_sums(level, rows, count, 5, lm.WEIGHTS, own)[:, k] == pytest.approx(want, rel=1e-12)

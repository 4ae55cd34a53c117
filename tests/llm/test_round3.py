"""What the third round's findings named, each with a table that showed it."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from starloom.llm import lm, packing, queries, segmentation

# ---- 2


def test_documents_and_turns_are_segmented_with_their_ids(spark, tmp_path):
    docs = [(1, "the cat sat"), (2, None), (2, "the cat sat"), (None, "naïve 日本 " + "x" * 300), (3, "a")]
    turns = [(1, 0, "the dog"), (1, 1, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(turns, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op2_gumbel_segmentation(spark, str(tmp_path)).collect()
    lat = segmentation.lattices()
    want = collections.Counter()
    for key, text in [((i, None, None), t) for i, t in docs] + [((None, c, n), t) for c, n, t in turns]:
        want[key, lat.decode(lat.model.encode(text or ""))] += 1 if not text else 2
    single = len(lat.sample(lat.normalize("a"), 2, random.Random(0))[0])
    want[(3, None, None), "a"] = single
    assert collections.Counter(((r.doc_id, r.conv_id, r.turn), lat.decode(list(r.ids))) for r in got) == want
    assert all(r.decoded_ok and r.n_pieces == len(r.ids) for r in got)


# ---- 4


def test_the_program_runs_where_best_fit_fills_every_sequence(monkeypatch):
    """Best-fit alone lays 2048s by two and 1024s by four; the program's configuration holds both."""
    monkeypatch.setattr(packing, "solve_program", lambda sizes, count, limit, rounds: [(np.array([2, 1]), 4.0)] if count.sum() else [])
    plan = packing.plan_patterns({2048: 4, 1024: 8}, 4096)
    assert [(dict(p.content), p.times) for p in plan] == [({2048: 1, 1024: 2}, 4)]


@pytest.mark.parametrize("kind", ["lognormal", "uniform"])
def test_no_rounding_is_worse_than_best_fit(monkeypatch, kind):
    rng = random.Random(3)
    draw = {"lognormal": lambda: min(int(rng.lognormvariate(6, 1.2)) + 1, 4096), "uniform": lambda: rng.randint(1, 4096)}[kind]
    lengths = collections.Counter(draw() for _ in range(4000))
    solve, solved = packing.solve_program, []
    monkeypatch.setattr(packing, "solve_program", lambda *a, **k: solved.append(1) or solve(*a, **k))
    plan = packing.plan_patterns(lengths, 4096)
    held = collections.Counter()
    for p in plan:
        assert sum(n * k for n, k in p.content) + p.room == 4096
        for n, k in p.content:
            held[n] += k * p.times
    assert held == lengths and solved
    assert packing.sequences(plan) <= packing.sequences(packing.plan_patterns(lengths, 4096, rounds=0))


# ---- 5


def test_pairs_beyond_the_broadcast_filter_keep_their_levels(spark, tmp_path):
    """Scores with a filter that has no room for rare pairs are those of a filter with room for all."""
    rng = random.Random(5)
    word = [f"w{k}" for k in range(3000)]
    texts = ["x y z " * 3 + " ".join(rng.choices(word, k=150)) for _ in range(120)] + [None, "", "x y"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i]) for i in range(0, 120, 3)] + [(None, "x y z"), (None, "x y z")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    score = lambda most: sorted(
        (r.id or -1, r.train, r.n_tokens, r.base_score, r.score) for r in lm.score(spark, f"{tmp_path}/d", "doc_id < 1000", most_bits=most).collect()
    )
    whole, bounded = score(1 << 28), score(1 << 14)
    assert [r[:3] for r in bounded] == [r[:3] for r in whole] and len(whole) == len(rows)
    apart = [abs(a[4] - b[4]) / a[2] for a, b in zip(whole, bounded, strict=True)]
    assert max(apart) < 0.05 and float(np.mean(apart)) < 0.005

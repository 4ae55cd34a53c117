"""Each task of the near-copies stage holds one Python worker at a time, and workers give their memory back."""

import numpy as np
import pyarrow as pa

from starloom.llm import jaccard, toxicity


def test_chosen_texts_and_their_marks_take_one_worker(spark):
    rows = spark.createDataFrame([(k, f"five words of row {k % 30}") for k in range(40)] + [(None, None), (77, "")], "d long, text string")
    got = jaccard._chosen_texts(rows, spark.range(10, 20))
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    marks = {r.text: r.mark for r in got.collect()}
    assert {f"five words of row {k}" for k in range(10, 20)} <= set(marks)
    for _, own, grams in jaccard.gram_sets(pa.array(list(marks))):
        assert jaccard.fingerprints(own, grams, len(marks))[1].tolist() == list(marks.values())


def test_slices_make_no_difference(monkeypatch):
    column = pa.array([None, "a b c d e f", "", *[" ".join(f"w{k * j % 17}" for j in range(k)) for k in range(60)]])

    def sets():
        return [(first + int(r), int(g)) for first, rows, grams in jaccard.gram_sets(column) for r, g in zip(rows, grams, strict=True)]

    whole = sets()
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 300)
    assert sets() == whole and len(whole) == len(set(whole))


def test_landmarks_come_from_counts_of_rows():
    bad = ["stupid fool", "stupid stupid idiot", "idiot fool stupid", "fool idiot"] * 3
    good = ["lovely weather today", "today idiot proof", "bread and lovely butter"] * 4
    columns = [pa.array(bad[:5]), pa.array(bad[5:] + good)]
    found = toxicity.choose_landmarks(columns, np.array([True] * len(bad) + [False] * len(good)), 2)
    assert found == [b"fool", b"stupid"]
    assert toxicity.choose_landmarks([pa.array(["a", "", None])], np.array([True, False, True]), 2) == []

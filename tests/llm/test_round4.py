"""Texts are looked up and moved once: the encoder's walk over known chunks, and exact dedup's shuffle."""

import numpy as np
import pytest

from starloom.llm import dedup, encode


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("most", [encode.MOST_BYTES, 0])
def test_ids_with_known_new_long_and_forgotten_chunks(monkeypatch, name, most):
    monkeypatch.setattr(encode, "MOST_BYTES", most)
    own = encode.Encoder(name)
    long = "ab1" * 200  # is never remembered
    for texts in (["a b", None, ""], ["a b", f"c {long} d", "b a"], [f"{long} {long}", "x a", "c d"], ["a b", "b a"]):
        whole = [np.array(own.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert own.encode(texts) == whole
    assert long not in own.known


def test_known_chunks_are_walked_once(monkeypatch):
    own = encode.Encoder("word_bpe_49k.json")
    own.encode(["a b c", "c d"])
    asked = []
    monkeypatch.setattr(own, "tokenizer", type("T", (), {"encode_batch_fast": lambda self, part, **_: asked.append(part)})())
    assert own.encode(["d c b a"]) and not asked and not own.known.missing


def test_a_text_among_the_columns_moves_once(spark, tmp_path, monkeypatch):
    """The rows that meet the state hold the text in the struct of their columns, and nowhere else."""
    rows = [(1, "x"), (2, "x"), (3, None), (4, ""), (None, "y"), (5, "x ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frame, met = type(docs), []
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, *a, **k: (met.append(self.columns), join(self, *a, **k))[1])
    stay = dedup.drop_copies(spark, docs)
    assert met[0] == ["r", "digest", "place"]
    assert sorted((r.doc_id or 0, r.text) for r in stay.collect()) == [(0, "y"), (2, "x"), (4, ""), (5, "x ")]
    path = str(tmp_path / "d")
    docs.write.parquet(path)
    met.clear()
    marked = dedup.mark_copies(spark, path, columns=["doc_id"])
    assert met[0] == ["r", "text", "digest", "place"]
    assert sorted((r.doc_id or 0, r.dup_group_size, r.dup_kept) for r in marked.collect()) == [
        (0, 1, True), (1, 2, False), (2, 2, True), (3, 2, False), (4, 2, True), (5, 1, True),
    ]

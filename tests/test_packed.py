"""Payloads and lines of a day take a fraction of their text on disk and read back as the same rows."""

import json
from datetime import date

from starloom.plans.daily import land
from starloom.sources import bronze


def test_layers_of_a_day_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "LINES_PER_FILE", 700)
    day = date(2026, 6, 1)
    at = tmp_path / "landing/source=s/ingestion_date=2026-06-01"
    at.mkdir(parents=True)
    elements = [{"a": k, "b": {"c": "some text " * 20}, "é": "ü "} for k in range(2000)] + [None, 7, {"a": "line\nbreak"}]
    text = json.dumps(elements, indent=1)
    (at / "f.json").write_text(text)
    schema = spark.createDataFrame([], "a string, b struct<c:string>, d string").schema

    def read(packed):
        base = str(tmp_path / f"base-{packed}")
        land(spark, str(tmp_path / "landing"), base, {}, packed)
        return base, sorted(bronze.read_elements(spark, base, "s", day, schema).collect(), key=str)

    (_, plain), (base, got) = read(False), read(True)
    assert got == plain and len(got) == 2003
    assert spark.read.text(f"{base}/bronze", wholetext=True).collect()[0].value.rstrip("\n") == text
    assert "line\nbreak" in {r.a for r in got}
    sizes = {layer: [f.stat().st_size for f in (tmp_path / "base-True" / layer).rglob("part-*")] for layer in ("bronze", "elements")}
    assert len(sizes["elements"]) == 3 and len(sizes["bronze"]) == 1
    assert all(sum(x) < len(text) / 8 for x in sizes.values())

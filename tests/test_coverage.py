"""Every operator of the inventory is named where it is built and where it is exercised."""

import pathlib
import re

INVENTORY = {"A": 11, "B": 17, "C": 8, "D": 10, "E": 6, "F": 6, "G": 7, "H": 21, "K": 23, "L": 13}
ROOT = pathlib.Path(__file__).parent.parent


def named(*globs):
    found = set()
    for path in (p for g in globs for p in ROOT.glob(g)):
        text = path.read_text()
        found |= set(re.findall(r"\b[A-L]\d{1,2}\b", text))
        for letter, first, last in re.findall(r"\b([A-L])(\d{1,2})-[A-L]?(\d{1,2})\b", text):
            found |= {f"{letter}{i}" for i in range(int(first), int(last) + 1)}
    return found


def test_every_id_is_built_and_exercised():
    ids = {f"{letter}{i}" for letter, n in INVENTORY.items() for i in range(1, n + 1)}
    assert ids - named(*[f"starloom/{d}/*.py" for d in ("functions", "operators", "sources", "streaming", "checks", "plans")], "starloom/*.py") == set()
    assert ids - named("starloom/queries/*.py", "tests/test_*.py") == set()

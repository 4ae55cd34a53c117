"""The Merkle manifest against a plain tree and its SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import merkle, queries
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx int, h string"
RNG = random.Random(3)
TABLES = {
    "empty": [],
    "one": [(1, None, None, None, None, 0, "")],
    "odd": [
        (RNG.choice([None, *range(40)]), RNG.choice([None, "a", "b", "é", "Z", ""]), "x", RNG.choice([None, 4]), RNG.choice([None, "", "A B", "abc", "É"]), 1, "h")
        for _ in range(600)
    ],
    "many sources": [(i, f"s{i % 300}", "x", 1, "T" * (i % 3), 1, "h") for i in range(700)],
    "hot source": [(i // 2, "s" if i % 3 else "t", "x", 1, "Tt" * 2000, 1, "h") for i in range(700)],
    "equal rows": [(7, "s", "x", 1, "Tt", 1, "h")] * 300,
}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows, arity):
    """One row per leaf, by climbing a tree of lists."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))

    def climb(nodes):
        paths, place = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, at in enumerate(place):
                lo = at - at % arity
                paths[k].append(("".join(nodes[lo:at]), "".join(nodes[at + 1 : lo + arity])))
                place[k] = at // arity
            nodes = [sha("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
        return nodes[0], paths

    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = own, *climb([leaf(r) for r in own])
    if not order:
        return []
    root, above = climb([trees[s][1] for s in order])
    out = []
    for s, upper in zip(order, above, strict=True):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths, strict=True):
            found = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                found = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            acc = leaf(found)
            for a, b in path + upper:
                acc = sha(a + acc + b)
            out.append((r[0], leaf(r), subroot, root, sha("".join(a + b for a, b in path + upper)), acc, acc == root))
    return out


@pytest.mark.parametrize(("name", "arity"), [("odd", 2), ("hot source", 3), *[(name, 16) for name in TABLES]])
def test_against_a_plain_tree(spark, rows, name, arity):
    docs = spark.createDataFrame(TABLES[name], SCHEMA)
    got = rows(merkle.verified_manifest(spark, docs, arity))
    assert got == sorted(plain(TABLES[name], arity), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("name", ["odd", "hot source"])
def test_sql_on_odd_tables(spark, name):
    docs = spark.createDataFrame(TABLES[name], SCHEMA)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert compare(merkle.verified_manifest(spark, docs), con, queries.REGISTRY["op13_merkle_manifest"].sql) is None


def test_query_against_sql(spark):
    q = queries.REGISTRY["op13_merkle_manifest"]
    assert compare(q.run(spark, SMALL), connect(SMALL), q.sql) is None


def test_numbering(spark):
    docs = spark.createDataFrame([(i % 50, f"s{i % 7}") for i in range(3000)], "k long, source string")
    got = merkle.number_rows(docs, "source", ["k"]).collect()
    for s in range(7):
        own = sorted((r.idx, r.k) for r in got if r.source == f"s{s}")
        assert [i for i, _ in own] == list(range(len(own))) and [k for _, k in own] == sorted(k for _, k in own)
        assert {(r.gid, r.n) for r in got if r.source == f"s{s}"} == {(s, len(own))}


def test_sides_of_a_proof_keep_their_order(spark):
    runs = [bytes([k]) * 32 for k in range(3)]
    path = F.array(F.struct(F.lit(b"".join(runs)).alias("run"), F.lit(1).alias("slot")), F.struct(F.lit(runs[0]).alias("run"), F.lit(0).alias("slot")))
    got = spark.range(1).select(merkle.fold(F.lit("a" * 64), path).alias("f"), merkle.proof_digest(path).alias("p")).first()
    before, after = runs[0].hex(), runs[2].hex()
    assert (got.f, got.p) == (sha(sha(before + "a" * 64 + after)), sha(before + after))

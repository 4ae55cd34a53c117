"""Hot keys and ordered checks against a brute-force count on random rows."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starloom import checks as k
from starloom.operators import dedupe
from starloom.operators.ordered import SLICE_BITS


def key(v):
    return (v is None, v if v is not None else 0)


def hot_rows(seed, n=400):
    """A third of the rows share one group, many share their values, some are null."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        group = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        low = rng.choice([None, 5, 5, 5, *range(0, 60, 3)])
        high = None if rng.random() < 0.05 or low is None else low + rng.choice([0, 1, 3, 3, 6])
        rows.append((group, low, high))
    return rows


@pytest.mark.parametrize("slice_bits", [4, 11, SLICE_BITS])
@pytest.mark.parametrize("grouped", [True, False])
def test_sequential_values_brute_force(spark, slice_bits, grouped):
    data = hot_rows(1)
    groups = defaultdict(list)
    for g, low, _ in data:
        if low is not None:
            groups[g if grouped else 0].append(low)
    want = Counter(
        ((g,) if grouped else ()) + (b, a)
        for g, values in groups.items()
        for a, b in zip(sorted(values), sorted(values)[1:])
        if b != a + 3
    )
    df = spark.createDataFrame(data, "g string, low int, high int")
    found = k.sequential_values(df, "low", 3, group_by=["g"] if grouped else [], slice_bits=slice_bits)
    assert Counter(map(tuple, found.violations.collect())) == want


@pytest.mark.parametrize("slice_bits", [4, 11, SLICE_BITS])
@pytest.mark.parametrize("grouped", [True, False])
@pytest.mark.parametrize("gaps", ["allowed", "not_allowed", "required"])
def test_ranges_brute_force(spark, slice_bits, grouped, gaps):
    data = hot_rows(2)
    groups = defaultdict(list)
    for g, low, high in data:
        groups[g if grouped else 0].append((low, high))
    fits = {"allowed": lambda a, b: a <= b, "not_allowed": lambda a, b: a == b, "required": lambda a, b: a < b}[gaps]
    want = Counter()
    for g, ranges in groups.items():
        ranges.sort(key=lambda r: (key(r[0]), key(r[1])))
        for i, (low, high) in enumerate(ranges):
            last = i + 1 == len(ranges)
            following = None if last else ranges[i + 1][0]
            ordered = low is not None and high is not None and low < high
            fitting = fits(high, following) if high is not None and following is not None else last
            if not (ordered and fitting):
                want[((g,) if grouped else ()) + (low, high, following, last, ordered, fitting)] += 1
    df = spark.createDataFrame(data, "g string, low int, high int")
    found = k.mutually_exclusive_ranges(df, "low", "high", "g" if grouped else None, gaps, slice_bits=slice_bits)
    assert Counter(map(tuple, found.violations.collect())) == want


def test_hot_keys_in_comparisons(spark):
    a = [(g, low) for g, low, _ in hot_rows(3)]
    b = [(g, low) for g, low, _ in hot_rows(4)] + a[:150]
    schema = "g string, low int"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    row = k.equality(left, right).verdict().first()
    assert row.failures == len(only_a) + len(only_b) + abs(len(only_a) - len(only_b))
    counts_a, counts_b = Counter(x for x, _ in a), Counter(x for x, _ in b)
    want = Counter(
        (g, n) for g in {*counts_a, *counts_b} if counts_a[g] != counts_b[g] for n in (counts_a[g], counts_b[g]) if n
    )
    assert Counter(map(tuple, k.cardinality_equality(left, "g", right, "g").violations.collect())) == want
    orphans = k.relationships(left, "low", right.filter("low > 20"), "low").violations
    assert orphans.count() == sum(1 for _, low in a if low is not None and low not in {x for _, x in b if x and x > 20})


def test_hot_key_dedupe(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.hash("id").alias("v"), "id"
    )
    got = dedupe.deduplicate(df, ["k"], [F.desc("v")])
    best = df.groupBy("k").agg(F.max_by("id", "v").alias("id"))
    assert got.count() == 20_001
    assert got.select("k", "id").exceptAll(best).isEmpty()

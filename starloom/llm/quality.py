"""Quality rules: learned decision lists over text statistics (operator 10).

Sequential covering: from the labelled rows, one rule after another is grown as a conjunction of thresholds
(by information gain on one part of the rows), pruned on the other part, and the rows that it covers are
set aside. Rules predict "bad"; what no rule covers is good. The list becomes one ordered Spark expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import SPACE, hashes, lean, per_row, spans, text_slices, windows, words

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits"]
SHARES = {
    "mean_word": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
}
FEATURES = ["n_words", "n_lines", *SHARES]


def _repeats(rows: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, hash): whether it occurs twice or more in its row, and whether it has occurred before."""
    order = np.lexsort((hashed, rows))  # stable, so the earlier of two equals comes first
    r, h = rows[order], hashed[order]
    same = np.zeros(len(r) + 1, bool)
    same[1:-1] = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    twice, again = np.empty(len(r), bool), np.empty(len(r), bool)
    twice[order] = same[1:] | same[:-1]
    again[order] = same[:-1]
    return twice, again


def count_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The COUNTS of every text, over the whole text; a null counts as empty and has zeros."""
    out = {name: np.zeros(len(column), np.int64) for name in COUNTS}
    for first, data, offsets in text_slices(column):
        n = len(offsets) - 1
        part = slice(first, first + n)
        start, end, row = words(data, offsets)
        hashed = hashes(data, start, end)
        owner = np.repeat(np.arange(n), np.diff(offsets))
        out["n_words"][part] = per_row(row, n)
        for name, mask in (
            ("word_chars", ~SPACE[data] & ((data & 0xC0) != 0x80)),
            ("n_symbols", SYMBOL[data]),
            ("n_upper", UPPER[data]),
            ("n_digits", DIGIT[data]),
        ):
            out[name][part] = per_row(owner[mask], n)
        _, again = _repeats(row, hashed)
        out["n_distinct"][part] = per_row(row[~again], n)
        lines = spans(data, offsets, data == 0x0A)
        used = np.searchsorted(start, lines[1]) > np.searchsorted(start, lines[0])  # a word begins in it
        line = [x[used] for x in lines]
        _, again = _repeats(line[2], hashes(data, line[0], line[1]))
        out["n_lines"][part] = per_row(line[2], n)
        out["n_dup_lines"][part] = per_row(line[2][again], n)
        grams, gram_row = windows(hashed, row, 3)
        twice, _ = _repeats(gram_row, grams)
        at = np.flatnonzero(row[:-2] == row[2:])[twice] if len(row) > 2 else np.zeros(0, np.int64)
        covered = np.zeros(len(row), bool)
        for k in range(3):
            covered[at + k] = True
        out["n_repeat_words"][part] = per_row(row[covered], n)
    return out


def with_statistics(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """All columns of `df` and the COUNTS, each under `prefix` + its name, as long.

    Nulls and empty texts have zeros. Raises ValueError if a name is taken.
    """
    taken = {prefix + c for c in COUNTS} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the frame already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = count_statistics(batch.column(names.index(text_col)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(found[c]) for c in COUNTS]], names=[*names, *[prefix + c for c in COUNTS]]
            )

    names = df.columns
    schema = T.StructType([*df.schema.fields, *[T.StructField(prefix + c, T.LongType()) for c in COUNTS]])
    return df.mapInArrow(lambda batches: lean(run(batches)), schema)


def feature(name: str, prefix: str = "") -> Column:
    """A statistic or a share of two, 0 where the divisor is 0."""
    if name not in SHARES:
        return F.col(prefix + name).cast("double")
    over, under = SHARES[name]
    under = F.col(prefix + under)
    return F.when(under > 0, F.col(prefix + over) / under).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, '<=' or '>=', threshold); precision and cover are those of the training rows."""

    terms: tuple[tuple[str, str, float], ...]
    covered: int
    precision: float

    def column(self, prefix: str = "") -> Column:
        out = F.lit(True)
        for name, sign, value in self.terms:
            out = out & (feature(name, prefix) <= value if sign == "<=" else feature(name, prefix) >= value)
        return out

    def text(self) -> str:
        return " and ".join(f"{name} {sign} {value:.6g}" for name, sign, value in self.terms)


def _holds(x: np.ndarray, terms: list[tuple[int, str, float]]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, sign, value in terms:
        out &= x[:, j] <= value if sign == "<=" else x[:, j] >= value
    return out


def _grow(x: np.ndarray, bad: np.ndarray, most: int) -> list[tuple[int, str, float]]:
    """Add the threshold with the largest gain until no good row is covered or nothing gains."""
    terms: list[tuple[int, str, float]] = []
    live = np.ones(len(x), bool)
    while len(terms) < most and (~bad[live]).any():
        p0, n0 = bad[live].sum(), (~bad[live]).sum()
        best = (1e-9, None)
        for j in range(x.shape[1]):
            v, b = x[live, j], bad[live]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            last = np.flatnonzero(np.append(v[1:] != v[:-1], True))[:-1]  # the ends of runs of equal values, but for the last
            if not len(last):
                continue
            p, n = np.cumsum(b)[last], np.cumsum(~b)[last]
            middle = (v[last] + v[last + 1]) / 2
            for sign, pp, nn in (("<=", p, n), (">=", p0 - p, n0 - n)):
                gain = pp * (np.log2((pp + 1e-9) / (pp + nn + 1e-9)) - np.log2(p0 / (p0 + n0)))
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, sign, float(middle[k])))
        if best[1] is None:
            break
        terms.append(best[1])
        live &= _holds(x, [best[1]])
    return terms


def _prune(terms: list[tuple[int, str, float]], x: np.ndarray, bad: np.ndarray) -> list[tuple[int, str, float]]:
    """Drop last terms while (covered bad - covered good) / covered gets no worse."""

    def worth(t: list[tuple[int, str, float]]) -> float:
        on = _holds(x, t)
        p, n = (bad & on).sum(), (~bad & on).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = terms
    for k in range(len(terms) - 1, 0, -1):
        if worth(terms[:k]) >= worth(best):
            best = terms[:k]
    return best


def learn_rules(
    x: np.ndarray, bad: np.ndarray, names: list[str], least_precision: float = 0.8, least_cover: int = 5, most_terms: int = 4, most_rules: int = 24, seed: int = 7
) -> list[Rule]:
    """Rules in the order in which they were found. No bad row, or no good one, gives no rule."""
    rules: list[Rule] = []
    part = np.random.default_rng(seed).random(len(x)) < 2 / 3
    live = np.ones(len(x), bool)
    while len(rules) < most_rules and (bad & live).sum() >= least_cover and (~bad & live).any():
        grow, check = live & part, live & ~part
        if not (bad & grow).any():
            break
        terms = _grow(x[grow], bad[grow], most_terms)
        terms = _prune(terms, x[check], bad[check]) if terms else terms
        on = _holds(x, terms) & live
        right = (bad & on).sum()
        if not terms or right < least_cover or right < least_precision * on.sum():
            break
        rules.append(Rule(tuple((names[j], s, v) for j, s, v in terms), int(on.sum()), float(right / on.sum())))
        live &= ~on
    return rules


def fit_rules(labelled: DataFrame, label_col: str, prefix: str = "", most_rows: int = 20_000, **options) -> list[Rule]:
    """Learn from rows that have their COUNTS (see `with_statistics`) and a label, 0 being bad.

    At most `most_rows` rows are taken, those with the smallest hash of their statistics; rows without a label
    are left out. Only statistics come to the driver, never texts.
    """
    values = [feature(c, prefix).alias(c) for c in FEATURES]
    picked = (
        labelled.where(F.col(label_col).isNotNull())
        .select(F.col(label_col).cast("int").alias("label"), *values)
        .orderBy(F.xxhash64(*FEATURES), "label")
        .limit(most_rows)
    )
    stats = picked.toArrow()  # `most_rows` rows of numbers
    x = np.column_stack([stats[c].to_numpy().astype(float) for c in FEATURES])
    label = stats["label"].to_numpy()
    order = np.lexsort((*x.T, label))  # rows come in any order
    return learn_rules(x[order], (label == 0)[order], FEATURES, **options)


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The number of the first rule that covers a row, from 1; null for rows that are good."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        out = F.when(rules[k - 1].column(prefix), F.lit(k)).otherwise(out)
    return out


def base_failed(prefix: str = "") -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    n = F.col(f"{prefix}n_words")
    return (n < 50) | (F.col(f"{prefix}n_repeat_words") * 100 > n * 50)


def with_verdict(counted: DataFrame, rules: list[Rule], prefix: str = "") -> DataFrame:
    """Rows with their COUNTS, and `base_failed`, `rule` (see `verdict`) and `kept`, all under `prefix`."""
    out = counted.withColumn(f"{prefix}base_failed", base_failed(prefix))
    out = out.withColumn(f"{prefix}rule", verdict(rules, prefix))
    return out.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & F.col(f"{prefix}rule").isNull())

"""Text columns: trimming, URL parts, slugs, mention flags."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnLike) -> Column:
    """The empty string becomes null; blanks that are spaces stay."""
    return F.nullif(as_column(c), F.lit(""))


def without_prefixes(c: ColumnLike, prefixes: list[str]) -> Column:
    out = as_column(c)
    for p in prefixes:
        out = F.replace(out, F.lit(p), F.lit(""))
    return out


def url_host(url: ColumnLike) -> Column:
    """Text before the first `/` and the first `?` once the scheme is gone; a port stays.

    `parse_url` is not used: it gives null for addresses without a scheme.
    """
    bare = without_prefixes(url, ["android-app://", "http://", "https://"])
    return F.regexp_extract(bare, "^[^/?]*", 0)


def url_path(url: ColumnLike) -> Column:
    """Text after the first `/` up to the next `?`; without a `/`, what starts at the `?`.

    With neither the whole text comes back, and fragments are kept. Starting at the `?` leaves
    nothing before it, so that case is the empty string.
    """
    bare = without_prefixes(url, ["http://", "https://"])
    slash = F.locate("/", bare)
    query = F.locate("?", bare)
    tail = (
        F.when(slash > 0, F.substr(bare, slash + 1))
        .when(query > 0, F.substr(bare, query))
        .otherwise(bare)
    )
    return F.split_part(tail, F.lit("?"), F.lit(1))


def url_parameter(url: ColumnLike, name: str) -> Column:
    """Text between `name=` and the next `&`; empty is null.

    The name is found as plain text, so `x=` also matches inside `max=`.
    """
    after = F.split_part(as_column(url), F.lit(f"{name}="), F.lit(2))
    return blank_to_null(F.split_part(after, F.lit("&"), F.lit(1)))


def slugify(c: ColumnLike) -> Column:
    """Lower case, runs of spaces and dashes to `_`, other signs dropped, `_` before a first digit."""
    joined = F.regexp_replace(F.lower(as_column(c)), "[ -]+", "_")
    kept = F.regexp_replace(joined, "[^a-z0-9_]+", "")
    return F.coalesce(F.regexp_replace(kept, "^(?=[0-9])", "_"), F.lit(""))


def slug(name: str) -> str:
    """The same rule for a column name known while the plan is built (pivot headers, K19)."""
    kept = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", name.lower()))
    return "_" + kept if kept[:1].isdigit() else kept


def mentions(columns: list[ColumnLike], pattern: str) -> Column:
    """H5: does the lowered text of the columns together match `pattern`? Nulls count as empty.

    A pattern of plain words is searched for in the bytes; others are regular expressions.
    """
    lowered = F.lower(F.concat_ws(" ", *[as_column(c) for c in columns]))
    words = pattern.split("|")
    if not all(re.fullmatch(r"\w+", w) for w in words):
        return lowered.rlike(pattern)
    # bound once, as in `tag_terms`
    return F.transform(F.array(lowered), lambda text: reduce(lambda a, b: a | b, [text.contains(w) for w in words]))[0]


def bool_to_text(c: ColumnLike) -> Column:
    """`true` / `false`, null stays null."""
    return as_column(c).cast("string")

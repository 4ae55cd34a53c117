"""Ordered keyword rules and the vocabulary tagger."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from starloom.functions.text import ColumnLike, as_column

# Labels, keywords and their order decide the results (the first rule that holds wins).
ROLE_FAMILIES = [
    ("ML Engineer", ["machine learning", "ml engineer"]),
    ("Data Engineer", ["data engineer"]),
    ("Data Scientist", ["data scientist", "data science"]),
    ("Data Analyst", ["data analyst", "analytics"]),
    ("AI Engineer", ["ai engineer", "artificial intelligence"]),
    ("Software Engineer", ["software engineer", "developer"]),
    ("DevOps / Platform", ["devops", "platform engineer", "infrastructure"]),
    ("Product", ["product manager", "product owner"]),
]
ROLE_FAMILY_DEFAULT = "Other"

SENIORITY_LEVELS = [
    ("Intern", ["intern"]),
    ("Lead/Principal", ["principal", "staff", "lead"]),
    ("Senior", ["senior", "sr.", "sr "]),
    ("Junior", ["junior", "jr.", "entry", "associate"]),
]
SENIORITY_DEFAULT = "Mid"

EMPLOYMENT_TYPES = [
    ("Contract", ["contract", "contractor"]),
    ("Part-time", ["part-time", "part time"]),
    ("Internship", ["intern"]),
]
EMPLOYMENT_DEFAULT = "Full-time"

SKILL_CATEGORIES = [
    ("cloud", ["aws", "gcp", "azure", "cloud", "kubernetes", "docker", "terraform"]),
    (
        "language",
        ["python", "sql", "java", "javascript", "typescript", "go", "scala", "rust", "ruby", "c++"],
    ),
    (
        "framework",
        ["pytorch", "tensorflow", "spark", "airflow", "kafka", "react", "django", "flask", "pandas"],
    ),
    ("database", ["postgres", "postgresql", "mysql", "mongodb", "snowflake", "redis"]),
]
SKILL_CATEGORY_DEFAULT = "other"

SKILL_TERMS = [
    "python", "java", "javascript", "typescript", "go", "scala", "rust", "ruby", "c++", "sql",
    "aws", "gcp", "azure", "kubernetes", "docker", "terraform", "linux",
    "spark", "airflow", "kafka", "hadoop", "snowflake", "dbt", "databricks",
    "pytorch", "tensorflow", "keras", "pandas", "numpy",
    "react", "angular", "vue", "django", "flask", "fastapi",
    "postgres", "postgresql", "mysql", "mongodb", "redis",
    "tableau", "power bi", "looker", "etl", "machine learning", "deep learning", "nlp",
]

REMOTE_WORDS = "remote"
REMOTE_OR_TELEWORK_WORDS = "remote|telework"

Rules = list[tuple[str, list[str]]]


def _first_rule(rules: Rules, holds, default: str) -> Column:
    chain = F
    for label, words in rules:
        chain = chain.when(holds(words), F.lit(label))
    return chain.otherwise(F.lit(default))


def classify_by_keyword(text: ColumnLike, rules: Rules, default: str) -> Column:
    """Label of the first rule with a keyword inside the lowered text."""
    lowered = F.lower(as_column(text))
    return _first_rule(
        rules, lambda words: reduce(lambda a, b: a | b, [lowered.contains(w) for w in words]), default
    )


def classify_by_value(value: ColumnLike, rules: Rules, default: str) -> Column:
    """Label of the first rule that lists the value itself."""
    value = as_column(value)
    return _first_rule(rules, lambda words: value.isin(words), default)


def tag_terms(text: ColumnLike, terms: list[str] = SKILL_TERMS, whole_word: bool = False) -> Column:
    """Array of the terms that occur anywhere in the lowered text, in vocabulary order.

    Terms match inside words (`java` in `javascript`), unless `whole_word` is set; see `tag_words`. The lowered text is
    bound once as a lambda variable: written into every test it would be lowered once per term, which costs more than
    the search.
    """
    distinct = list(dict.fromkeys(terms))
    if whole_word:
        return tag_words(text, distinct)

    def found_in(lowered: Column) -> Column:
        return F.filter(F.array(*[F.lit(t) for t in distinct]).cast("array<string>"), lambda t: lowered.contains(t))

    lowered = F.lower(F.coalesce(as_column(text), F.lit("")))
    return F.transform(F.array(lowered), found_in)[0]


# Letters and digits, with the signs that names like `c++` and `c#` end in.
_WORD = r"[\p{L}\p{N}]+[+#]*"


def tag_words(text: ColumnLike, terms: list[str]) -> Column:
    """H6 by whole words: the terms whose words stand in the lowered text one after the other, in vocabulary order.

    The text is cut into words once. Terms of one word are looked up in the set of its words, so the size of the
    vocabulary hardly counts. A term of several words is looked for only in texts that have its first word, at the
    words' positions: punctuation between them doesn't matter, and nothing matches inside a word. Terms without a
    letter or digit never match.
    """
    cut = {t: re.findall(r"[^\W_]+[+#]*", t.lower()) for t in terms}
    single = {t: w[0] for t, w in cut.items() if len(w) == 1}
    phrases = {t: w for t, w in cut.items() if len(w) > 1}

    def found_in(words: Column) -> Column:
        """Terms of one word come from one intersection, in the vocabulary's order; phrases are tested one by one."""
        names = list(dict.fromkeys(single.values()))
        here = F.array_intersect(F.array(*[F.lit(w) for w in names]), words) if names else F.array().cast("array<string>")
        if not phrases and all(t == w for t, w in single.items()):
            return here
        row = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
        tests = {t: F.array_contains(here, w) for t, w in single.items()}
        for t, parts in phrases.items():
            tests[t] = F.array_contains(words, parts[0]) & row.contains(f" {' '.join(parts)} ")
        return F.array_compact(F.array(*[F.when(tests[t], F.lit(t)) for t in cut if t in tests]))

    words = F.regexp_extract_all(F.lower(F.coalesce(as_column(text), F.lit(""))), F.lit(_WORD), 0)
    return F.transform(F.array(words), found_in)[0]

"""Data-quality checks: each gives the violating rows and a verdict."""

from starloom.checks.groups import (
    at_least_one,
    equal_rowcount,
    fewer_rows_than,
    not_constant,
    not_null_proportion,
    recency,
    unique,
    unique_combination_of_columns,
)
from starloom.checks.ordering import mutually_exclusive_ranges, sequential_values
from starloom.checks.outcome import Check, verdicts
from starloom.checks.planner import planned_verdicts
from starloom.checks.relations import (
    cardinality_equality,
    equality,
    expect_table_columns_to_match_set,
    relationships,
    relationships_where,
)
from starloom.checks.rows import (
    accepted_range,
    accepted_values,
    assert_equal,
    expression_is_true,
    not_accepted_values,
    not_empty_string,
    not_null,
)

__all__ = [
    "Check",
    "accepted_range",
    "accepted_values",
    "assert_equal",
    "at_least_one",
    "cardinality_equality",
    "equal_rowcount",
    "equality",
    "expect_table_columns_to_match_set",
    "expression_is_true",
    "fewer_rows_than",
    "mutually_exclusive_ranges",
    "not_accepted_values",
    "not_constant",
    "not_empty_string",
    "not_null",
    "not_null_proportion",
    "planned_verdicts",
    "recency",
    "relationships",
    "relationships_where",
    "sequential_values",
    "unique",
    "unique_combination_of_columns",
    "verdicts",
]

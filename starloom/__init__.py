"""starloom: raw JSON feeds to a tested star schema, written as plain Spark jobs."""

__version__ = "0.1.0"

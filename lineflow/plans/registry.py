"""All queries of the line engine."""

from lineflow.plans import format_queries, line_queries

assert format_queries  # registers its queries with those of line_queries
QUERIES, ORACLES = line_queries.QUERIES, line_queries.ORACLES

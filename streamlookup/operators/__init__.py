"""DataFrame operators: lookup joins, grouping, latest per key, user hooks."""

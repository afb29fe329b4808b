"""Column expressions: URL hosts, message composition, event time, keys."""

"""The enrichment flows, and the queries that run over the driver's tables."""

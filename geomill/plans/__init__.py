"""Views over the given tables and the registry of queries."""

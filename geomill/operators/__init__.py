"""Operators over DataFrames: zonal statistics, releases, surfaces, catalog, relevance, work lists, merges, requests."""

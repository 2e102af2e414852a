"""Spark jobs for zonal extraction, money surfaces, raster catalogs, relevance and requests."""

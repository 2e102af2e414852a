"""Column functions: names, dates, years, masks, hashes, boxes and grids."""

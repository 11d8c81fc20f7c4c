"""Operators on the lattice: grids, points, clouds, boxes, polygons, aggregation, rasters, quality."""

"""Operators over DataFrames: consensus, learning, grids, hazards and tides."""

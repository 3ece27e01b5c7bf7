"""DataFrame operators: pairs, components, matching, raster union, splits, statistics, pixels."""

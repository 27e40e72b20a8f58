"""DataFrame operators: flags, grids, footprints, interpolation, models."""

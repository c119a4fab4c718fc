"""functions of the raster-as-table engine."""

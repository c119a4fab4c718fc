"""Raster-as-table analytics on Spark: point clouds, class rasters, score cubes and tile catalogues as DataFrames."""

__version__ = "0.1.0"

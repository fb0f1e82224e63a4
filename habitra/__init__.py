"""Geospatial observations, raster time series and model-ready feature tables on PySpark."""

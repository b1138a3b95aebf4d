"""Pixel-cube analytics for satellite vegetation and fire records, on PySpark DataFrames."""

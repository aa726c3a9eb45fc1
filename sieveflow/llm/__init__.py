"""Operators of a training-data pipeline: language ID, near-dedup, sharding,
mixing, nearest neighbours, token counts, packing, secret scans, token files.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns DataFrames; intermediate tables go to the folder that
``spark.checkpoint.dir`` names.
"""

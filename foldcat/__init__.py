"""foldcat: an incremental catalogue of binary objects that handles equal content once.

Everything here takes and returns Spark DataFrames. See README.md for the map of modules.
"""

"""Static-analysis data processing on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame``. Tables carry ``project`` as their leading
key, so one job covers many projects at once.
"""

"""tarnkit: keep a data lake in order with plain Spark DataFrames.

functions/  column expressions (time parts, Z-order codes)
sources/    reading, writing, converting and landing datasets
operators/  DataFrame -> DataFrame operators (layout, zones, profile, quality, merge, retention)
plans/      jobs that write: the trip transform and versioned tables
"""

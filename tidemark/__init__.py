"""tidemark: release-by-release analytics as plain Spark DataFrame functions.

Data arrives as successive releases of the same feeds.  The package lands raw
all-string records, types and validates them, keeps the newest row per business
key, derives slowly changing history, benchmarks scores against their peers and
rolls them up, with checks before and after.  Everything is a function from
DataFrames to DataFrames; jobs that write are in ``tidemark.plans``.
"""

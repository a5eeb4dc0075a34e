"""Business jobs: DataFrames in, one report DataFrame out.

No job reads the clock or a table by name; the run date is ``as_of`` and the
snapshots that reports exchange in a circle are passed in as ``prior_*``.
"""

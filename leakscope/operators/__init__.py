"""Set operations on DataFrames: keyed writes, ranking, search, scoring."""

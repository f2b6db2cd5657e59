"""Set-based operators: pure functions from DataFrames (and parameters) to DataFrames."""

"""DataFrame operators: each takes and returns DataFrames and keeps no state."""

"""Table-to-table operators. Each takes and returns DataFrames and is lazy unless it says otherwise."""

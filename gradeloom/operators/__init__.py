"""Table-level operators: most map DataFrames to a lazy DataFrame; those that read their rows more than once store them when called, and say so."""

"""Graph, rule and text operators: DataFrames in, DataFrames out."""

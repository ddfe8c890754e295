"""Column-generic operators: DataFrame in, DataFrame out."""

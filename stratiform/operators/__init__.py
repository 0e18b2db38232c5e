"""Table-wide operators: DataFrame in, DataFrame out, with column names and thresholds as arguments."""

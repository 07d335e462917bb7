"""The analytics operators: DataFrames and thresholds in, a DataFrame out, no actions."""

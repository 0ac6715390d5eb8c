"""The pipeline's operators: pure functions of DataFrames."""

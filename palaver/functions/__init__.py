"""Column functions: every one takes columns and returns a column, without a Python UDF."""

"""Event analytics on Spark: every operator maps a DataFrame to a DataFrame."""

"""Register, grid and weather table analytics on Spark DataFrames."""

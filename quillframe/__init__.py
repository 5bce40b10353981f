"""Table, text, time-series and experiment-data operators on Spark DataFrames."""

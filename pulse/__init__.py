"""Event-time metrics over a mixed stream of business events, on Spark DataFrames."""

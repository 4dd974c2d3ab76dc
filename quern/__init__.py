"""Quern: segment, log and event analytics on Spark DataFrames."""

"""Listing analytics and time-to-sale prediction on Spark DataFrames."""

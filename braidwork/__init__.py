"""Interval, count-matrix and corpus analytics on Spark DataFrames."""

"""Learner-journey analytics on Spark DataFrames."""

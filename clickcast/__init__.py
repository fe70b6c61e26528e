"""Predict which ad clicks lead to an install: features, models and scoring on Spark DataFrames."""

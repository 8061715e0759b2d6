"""Models, reports and checks: plain functions from DataFrames to a DataFrame."""

"""Layered (bronze, silver, gold) analytics for insurance contracts on Spark DataFrames."""

"""Clickstream analytics and recommendation operators for Spark.

Every operator is a function from DataFrames to a DataFrame. Interactions are
the only large input; each operator aggregates or caps them per key before it
joins or ranks, so no key can pull an unbounded group into one task.
"""

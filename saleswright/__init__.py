"""Retail sales warehouse and data-quality operators for Spark.

Everything is a function from DataFrames to a DataFrame; the plan stays lazy
until a sink or the caller runs it.
"""

__version__ = "0.1.0"

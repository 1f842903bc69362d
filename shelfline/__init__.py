"""Retail warehouse jobs on Spark: every job is a function from DataFrames to a DataFrame."""

from shelfline.rules import RetailRules

__all__ = ["RetailRules"]

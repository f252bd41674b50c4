"""Operators over DataFrames that are not tied to one model."""

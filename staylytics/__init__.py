"""Marketplace-listing price analytics as Spark DataFrame operators.

``functions`` holds column expressions, ``sources`` reads and writes tables,
``operators`` maps DataFrames to DataFrames, ``plans`` chains operators into the
whole path from raw listings to price quotes.
"""

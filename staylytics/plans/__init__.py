"""Operators chained into the stages from raw listings to quotes."""

"""DataFrame operators: ``fn(df, parameters) -> DataFrame``."""

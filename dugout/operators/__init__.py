"""Table operators: every one is ``f(df, ...) -> DataFrame``."""

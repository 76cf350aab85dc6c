"""DataFrame operators. Each is ``op(df, *, columns...) -> DataFrame``."""

"""Column-expression helpers: every rule is a native Spark ``Column``."""

"""Column-level helpers built only from Spark built-ins."""

"""DataFrame operators that Spark has no single built-in for."""

"""Card-clearing analytics as plain Spark DataFrame functions."""

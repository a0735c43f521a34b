"""ledgerlane: portfolio-style data work expressed as Spark DataFrame functions."""

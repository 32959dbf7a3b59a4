"""Sales-conversion reporting as Spark DataFrame functions."""

"""tripline: trip-record analytics written as Spark DataFrame jobs."""

"""tarmac: on-time-performance analytics as Spark DataFrame jobs."""

"""Point-in-time analytics on Spark: bitemporal tables, intervals, as-of joins and rolling measures."""

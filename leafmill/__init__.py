"""Document analytics on Spark: typed page blocks, validators, review gates, assembly."""
